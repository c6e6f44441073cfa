"""Token counts of a byte-pair vocabulary without producing tokens.

Byte-pair merging on a linked list of symbols with a heap of adjacent pairs: pop
the pair of lowest rank (leftmost among equals), merge it, push its two new
neighbours. The number of tokens is the number of initial symbols minus the
number of merges; no identifier is ever looked up. A character outside the
vocabulary counts as its UTF-8 bytes (byte fallback).

Merges never cross two neighbouring characters that stand side by side in no
piece of the vocabulary, so a text may be cut there without changing its count.
Each piece of text between such cuts is counted once per task process (a bounded
memo); the whole text is always counted.

The vocabulary is a SentencePiece BPE model file (identity normaliser, dummy
prefix, byte fallback). The counts equal those of the ``sentencepiece`` library
with its defaults: no begin, end or added special tokens; strings such as
``<s>`` inside a text are ordinary text. Null and empty texts have 0 tokens.
Extra columns are ignored; repeated ids give repeated rows.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.work import small_batches

MARK = "▁"  # SentencePiece's visible space
MEMO = 400_000
MEMO_CHARS = 64
LIMIT = 4096


class Vocabulary:
    """Ranks of the mergeable pieces of a SentencePiece BPE model."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as f:
            model = sentencepiece.SentencePieceProcessor(model_proto=f.read())
        probe = "ﬁ Ａ  x½\ty "
        if model.normalize(probe) != MARK + probe.replace(" ", MARK):
            raise ValueError(f"{path} changes texts before it splits them; only models that keep them are counted here")
        if not any(model.is_byte(i) for i in range(model.get_piece_size())):
            raise ValueError(f"{path} has no byte pieces for characters outside its vocabulary")
        self.rank: dict[str, float] = {}
        for i in range(model.get_piece_size()):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)):
                self.rank[model.id_to_piece(i)] = -model.get_score(i)
        self.neighbours = {a + b for piece in self.rank for a, b in zip(piece, piece[1:])}
        self._memo: dict[str, int] = {}
        self._parts: dict[str, int] = {}
        # a space starts a new word, and nothing merges across a line break if no piece holds one
        breaks = "" if any("\n" in pair for pair in self.neighbours) else "\n"
        self._words = re.compile(f"{MARK}+[^{MARK}{breaks}]*|[^{MARK}{breaks}]+|{breaks or MARK}")

    def merges(self, text: str) -> int:
        """Merges that byte-pair encoding makes in ``text``."""
        n = len(text)
        rank = self.rank
        symbol: list[str | None] = list(text)
        left = list(range(-1, n - 1))
        right = [*range(1, n), -1]
        heap = []
        for i in range(n - 1):
            pair = text[i:i + 2]
            if pair in rank:
                heap.append((rank[pair], i, pair))
        heapq.heapify(heap)
        done = 0
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = right[i]
            if symbol[i] is None or j < 0 or symbol[i] + symbol[j] != pair:
                continue  # one of the two has been merged since
            done += 1
            symbol[i], symbol[j] = pair, None
            right[i] = right[j]
            if right[i] >= 0:
                left[right[i]] = i
                wider = pair + symbol[right[i]]
                if wider in rank:
                    heapq.heappush(heap, (rank[wider], i, wider))
            if left[i] >= 0:
                wider = symbol[left[i]] + pair
                if wider in rank:
                    heapq.heappush(heap, (rank[wider], left[i], wider))
        return done

    def _part(self, part: str) -> int:
        known = self._parts.get(part)
        if known is None:
            symbols = sum(1 if c in self.rank else len(c.encode()) for c in part)
            known = symbols - (self.merges(part) if len(part) > 1 else 0)
            if len(part) <= MEMO_CHARS:
                if len(self._parts) >= MEMO:
                    self._parts.clear()
                self._parts[part] = known
        return known

    def _word(self, word: str) -> int:
        lo, total, pairs = 0, 0, self.neighbours
        for i in range(1, len(word)):
            if word[i - 1:i + 1] not in pairs:
                total += self._part(word[lo:i])
                lo = i
        total += self._part(word[lo:])
        if len(word) <= MEMO_CHARS:
            if len(self._memo) >= MEMO:
                self._memo.clear()
            self._memo[word] = total
        return total

    def count(self, text: str) -> int:
        if not text:
            return 0
        memo, total = self._memo, 0
        for word in self._words.findall(MARK + text.replace(" ", MARK)):
            n = memo.get(word)
            total += self._word(word) if n is None else n
        return total


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary per task process."""
    return Vocabulary(path)


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array([vocab.count(t) for t in texts], pa.int64()),
                ],
                names=["id", "n_bytes", "n_tokens"],
            )

    return run


def token_counts(
    docs: DataFrame,
    vocabulary_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = LIMIT,
) -> DataFrame:
    """``id, n_bytes, n_tokens, over_limit`` of every whole text.

    ``vocabulary_path`` must be readable on every executor (an installed file).
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    counts = texts.mapInArrow(_count(vocabulary_path), "id long, n_bytes long, n_tokens long")
    return counts.select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
