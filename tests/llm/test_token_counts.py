import random

import public_tokenizers
import pytest
import sentencepiece

from tablewright.llm.token_counts import Vocabulary, token_counts

from ..conftest import SF001
from . import edge

PATH = public_tokenizers.path("piece_bpe_32k.model")


def test_counts_equal_the_library(spark):
    lib = sentencepiece.SentencePieceProcessor(model_file=PATH)
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = {r.doc_id: r for r in token_counts(docs, PATH).collect()}
    for r in docs.collect():
        assert got[r.doc_id].n_tokens == len(lib.encode(r.text)), r.doc_id
        assert got[r.doc_id].n_bytes == len(r.text.encode())
        assert got[r.doc_id].over_limit == (got[r.doc_id].n_tokens > 4096)


def test_awkward_strings_equal_the_library():
    lib = sentencepiece.SentencePieceProcessor(model_file=PATH)
    vocab = Vocabulary(PATH)
    rnd = random.Random(1)
    pool = [*" \n\tabeXé日😀▁%$<s>/&;.,1 　́\x00", "the", "<0x0A>", "    ", "\r\n", "</s>", "<unk>"]
    texts = ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    texts += ["", " ", "a" * 5000, " " * 3000, "the" * 2000, "Ａ①é"]
    assert [vocab.count(t) for t in texts] == [len(lib.encode(t)) for t in texts]


def test_models_that_change_texts_are_refused(monkeypatch):
    kind = sentencepiece.SentencePieceProcessor
    with monkeypatch.context() as m:
        m.setattr(kind, "normalize", lambda self, text: "▁" + text.replace("ﬁ", "fi").replace(" ", "▁"))
        with pytest.raises(ValueError, match="changes texts"):
            Vocabulary(PATH)
    monkeypatch.setattr(kind, "is_byte", lambda self, i: False)
    with pytest.raises(ValueError, match="byte pieces"):
        Vocabulary(PATH)


def test_edge_cases(spark):
    got = token_counts(edge.table(spark), PATH).collect()
    assert len(got) == len(edge.ROWS)
    assert {r.n_tokens for r in got if r.doc_id in (1, 2)} == {0}
    assert any(r.over_limit for r in got if r.doc_id == 7)
    assert token_counts(edge.empty(spark), PATH).collect() == []
