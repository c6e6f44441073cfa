"""Rule bitmask ledger: measure once, keep failure bits, apply policies later.

``measure`` makes one pass over the texts (vectorised over byte blocks) and
``ledger`` evaluates every rule once on the measurements: bit ``i`` of
``failures`` is set if rule i fails. A policy is a named, versioned set of rules;
applying one is a bitwise AND with its mask, and an ablation report (how many
documents each rule decides alone, how many stay without it) is one bitwise
aggregation over the ledger, never a second pass over the texts.

Words are ``[^\\x20\\x09-\\x0D]+``. Null text counts as empty (no words, one empty
line); such a document fails the length rule. Extra columns are ignored,
repeated ids give repeated rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm import arrays
from tablewright.llm.work import small_batches

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_IS_ALPHA = np.zeros(256, bool)
_IS_ALPHA[65:91] = _IS_ALPHA[97:123] = True
_IS_ALPHA[128:] = True  # letters outside ASCII
_IS_UPPER = np.zeros(256, bool)
_IS_UPPER[65:91] = True

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_alpha_words", "n_upper", "n_letters", "longest_word",
)


def _repeat_words(hashes: np.ndarray, bounds: np.ndarray, n: int) -> np.ndarray:
    """Words inside 5-word windows that occur twice or more in their text."""
    total = len(hashes)
    if total < WINDOW:
        return np.zeros(n, np.int64)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    inside = np.flatnonzero(owner[:total - WINDOW + 1] == owner[WINDOW - 1:])
    value = np.zeros(total - WINDOW + 1, np.uint64)
    for j in range(WINDOW):
        value = value * np.uint64(0x2545F4914F6CDD1D) + hashes[j:total - WINDOW + 1 + j]
    key = arrays.mix64(arrays.mix64(value[inside]) ^ arrays.mix64(owner[inside].astype(np.uint64)))
    order = np.argsort(key)
    ordered = key[order]
    same = ordered[1:] == ordered[:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(total + 1, np.int64)
    at = inside[twice]
    np.add.at(cover, at, 1)
    np.add.at(cover, at + WINDOW, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(cover[:-1]) > 0)])
    return covered[bounds[1:]] - covered[bounds[:-1]]


def _dup_lines(block: arrays.Block, solid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word that equal an earlier line of their text, and all lines."""
    starts, ends, owner = block.lines()
    words = np.concatenate([[0], np.cumsum(solid)])
    full = words[ends] > words[starts]
    n_lines = np.bincount(owner, minlength=block.n)
    starts, ends, owner = starts[full], ends[full], owner[full]
    if not len(starts):
        return np.zeros(block.n, np.int64), n_lines
    key = block.hashes(starts, ends)
    order = np.lexsort((key, owner))
    new = np.ones(len(key), bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    return (
        np.bincount(owner, minlength=block.n)
        - np.bincount(owner[order][new], minlength=block.n)
    ), n_lines


def measure_block(block: arrays.Block) -> dict[str, np.ndarray]:
    data = block.data
    solid = ~arrays.SPACE[data]
    starts, ends = block.runs(solid)
    bounds = block.owners(starts)
    n_words = np.diff(bounds)
    dup_lines, n_lines = _dup_lines(block, solid)
    alpha = np.concatenate([[0], np.cumsum(_IS_ALPHA[data])])
    head = (data & 0xC0) != 0x80  # first byte of a code point
    points = np.concatenate([[0], np.cumsum(head)])
    owner = np.repeat(np.arange(block.n), n_words)
    longest = np.zeros(block.n, np.int64)
    np.maximum.at(longest, owner, points[ends] - points[starts])
    return {
        "n_words": n_words,
        "word_chars": block.counts(solid & head),
        "n_symbols": block.counts(_IS_SYMBOL[data]),
        "n_dup_lines": dup_lines,
        "n_repeat_words": _repeat_words(block.hashes(starts, ends), bounds, block.n),
        "n_lines": n_lines,
        "n_alpha_words": np.bincount(owner[alpha[ends] > alpha[starts]], minlength=block.n),
        "n_upper": block.counts(_IS_UPPER[data]),
        "n_letters": block.counts(_IS_ALPHA[data] & head),
        "longest_word": longest,
    }


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in arrays.blocks(batch.column(1)):
            found = measure_block(block)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(block.first, block.n)]
                + [pa.array(found[m].astype(np.int64)) for m in MEASURES],
                names=["id", *MEASURES],
            )


def measure(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measurements of every whole text, one row per document."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = "id long, " + ", ".join(f"{m} long" for m in MEASURES)
    return texts.mapInArrow(_measure, schema).withColumnRenamed("id", id_col)


# ---------------------------------------------------------------------------
# rules and policies


@dataclass(frozen=True)
class Rule:
    """``fails``: SQL condition over the measurements, null-free whole numbers."""

    name: str
    fails: str


# The position of a rule is its bit; append only, so that stored ledgers stay readable.
RULES = (
    Rule("too_few_words", "n_words < 10"),
    Rule("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule("too_many_words", "n_words > 100000"),
    Rule("short_mean_word", "word_chars < 2 * n_words"),
    Rule("long_mean_word", "word_chars > 12 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("duplicate_lines", "100 * n_dup_lines > 30 * n_lines"),
    Rule("few_letter_words", "100 * n_alpha_words < 70 * n_words"),
    Rule("shouting", "2 * n_upper > n_letters"),
    Rule("endless_word", "longest_word > 1000"),
)
BASE = ("too_few_words", "repeated_windows")
POLICIES = {
    "base.v1": BASE,
    "web.v1": (*BASE, "too_many_words", "short_mean_word", "long_mean_word", "symbols", "duplicate_lines"),
    "web.v2": tuple(r.name for r in RULES if r.name != "too_many_words"),
}
CURRENT = "web.v2"


def mask_of(names, rules: tuple[Rule, ...] = RULES) -> int:
    """The bit mask of some rules; an unknown name raises ``KeyError``."""
    bit = {r.name: 1 << i for i, r in enumerate(rules)}
    out = 0
    for name in names:
        out |= bit[name]
    return out


def ledger(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``measured`` with ``failures``: one bit for each rule that fails."""
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn("failures", bits)


def fails(policy: str, failures: str = "failures") -> Column:
    """Whether a ledger row fails a policy."""
    return F.col(failures).bitwiseAND(F.lit(mask_of(POLICIES[policy])).cast("long")) != 0


def ablations(rows: DataFrame, policy: str = CURRENT, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per rule of a policy: documents it fails, decides alone, and that stay without it.

    One aggregation over the failure bits.
    """
    mask = mask_of(POLICIES[policy], rules)
    failed = F.col("failures").bitwiseAND(F.lit(mask).cast("long"))
    measures = [F.count("*").alias("documents"), F.sum((failed == 0).cast("long")).alias("kept")]
    names = POLICIES[policy]
    for name in names:
        bit = F.lit(mask_of([name], rules)).cast("long")
        measures += [
            F.sum((failed.bitwiseAND(bit) != 0).cast("long")).alias(f"failed_{name}"),
            F.sum((failed == bit).cast("long")).alias(f"alone_{name}"),
        ]
    one = rows.agg(*measures)
    stacked = ", ".join(f"'{n}', failed_{n}, alone_{n}, kept + alone_{n}" for n in names)
    return one.select(
        "documents", "kept",
        F.expr(f"stack({len(names)}, {stacked}) as (rule, failed, decided_alone, kept_without)"),
    )
