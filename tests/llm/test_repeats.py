import random

import pytest

from tablewright.llm import repeats

from ..conftest import SF001
from . import brute, edge


def _rows(df, **kw):
    out = repeats.remove_repeats(df, **kw).collect()
    return {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in out}


def _random_docs():
    rnd = random.Random(5)
    base = ["".join(rnd.choice("ab") for _ in range(rnd.randint(30, 300))) for _ in range(6)]
    docs = []
    for i in range(50):
        text = ""
        for _ in range(rnd.randint(0, 3)):
            b = rnd.choice(base)
            s = rnd.randrange(len(b))
            text += b[s:s + rnd.randint(1, 200)] + "".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 30)))
        docs.append((i, text if i % 17 else None))
    return docs + [(100, "x" * 500), (101, "yz" * 300), (102, "é" * 200 + "x" * 90)]


@pytest.mark.parametrize("hot", [0, 3, 10_000])
def test_matches_brute_force_with_and_without_hot_groups(spark, hot):
    docs = _random_docs()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert _rows(df, length=40, gram=8, hot=hot) == brute.remove_repeats(docs, 40)


def test_planted_passages_in_many_files(spark, monkeypatch):
    """Passages of 51 to 90 words in two or three documents each, over many partitions and buckets.

    Those of at least 400 bytes are cut from all their documents; shorter ones are no
    repeats by the contract, however many words they have. Clean documents stay whole.
    """
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 11)))
    texts, long_, short = [" ".join(word() for _ in range(rnd.randint(80, 300))) for _ in range(600)], set(), set()
    for p in range(60):
        passage = " ".join(word() for _ in range(rnd.randint(51, 90)))
        for i in range(5 * p, 5 * p + 2 + p % 2):
            cut = texts[i].index(" ", 200)
            texts[i] = f"{texts[i][:cut]} {passage}{texts[i][cut:]}"
            (long_ if len(passage) + 2 >= 400 else short).add(i)
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 10_000)
    got = _rows(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(23))
    assert got == brute.remove_repeats(list(enumerate(texts)), 400)
    assert {d for d, r in got.items() if r[1]} == long_ and long_ and short


def test_table_at_the_real_length(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert _rows(docs) == brute.remove_repeats(rows, 400)


def test_edge_cases(spark):
    df = edge.table(spark).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    got = _rows(df)
    rows = {r[0]: r[1] for r in edge.ROWS if r[0] is not None}
    assert got == brute.remove_repeats(list(rows.items()), 400)
    assert repeats.remove_repeats(edge.empty(spark)).collect() == []


def test_null_and_repeated_ids_are_documents_of_their_own(spark):
    rnd = random.Random(9)
    text = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    passage, other = text(450), text(420)
    big = 2**60 + 1
    docs = [
        (None, passage + text(50)), (1, text(30) + passage), (None, text(600)), (2, other + text(90)),
        (2, text(500)), (2, text(70) + other), (big, text(20) + passage), (big + 1, text(700)), (None, None), (3, passage),
    ]
    want = sorted(brute.remove_repeats(list(enumerate(t for _, t in docs)), 400).items())
    want = sorted((str(docs[n][0]), *row) for n, row in want)
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    got = repeats.remove_repeats(df).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in got) == want


def test_pieces_of_a_long_text_give_the_places_of_the_whole(monkeypatch):
    import numpy as np

    data = np.frombuffer(random.Random(1).randbytes(5000), np.uint8)
    whole = repeats.text_places(data, 100, 8)
    monkeypatch.setattr(repeats, "_TEXTS_AT_ONCE", 700)
    for a, b in zip(whole, repeats.text_places(data, 100, 8)):
        assert (a == b).all()


def test_loser_tree_merges_front_coded_runs():
    rnd = random.Random(2)
    runs, flat = [], []
    for _ in range(7):
        run = sorted(bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 12))) for _ in range(rnd.randint(0, 30)))
        lengths, tails = repeats.front_code(run)
        runs.append(repeats.Run(lengths, tails, run))
        flat += run
    merged = list(repeats.merge_runs(runs))
    assert [m[0] for m in merged] == sorted(flat) == [m[2] for m in merged]
    for (a, _, _), (b, lcp, _) in zip(merged, merged[1:]):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        assert lcp == n


def test_reach_agrees_with_all_pairs():
    rnd = random.Random(4)
    for _ in range(200):
        g = rnd.randint(1, 9)
        items = sorted(
            (bytes(rnd.choice(b"ab") for _ in range(rnd.randint(4, 8))),
             bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 6)))) for _ in range(g)
        )
        pre = repeats.shared_prefix
        lcps = [0] + [pre(items[i - 1][0], items[i][0]) for i in range(1, g)]
        before, after = repeats.reach(lcps, [x[1] for x in items], 8)
        for i in range(g):
            pairs = [(pre(items[i][1], items[j][1]), pre(items[i][0], items[j][0])) for j in range(g) if j != i]
            good = [(x, y) for x, y in pairs if x + y >= 8]
            assert before[i] == max((x for x, _ in good), default=0)
            assert after[i] == max((y for _, y in good), default=0)
