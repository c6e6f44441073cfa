import numpy as np
import pyarrow as pa

from tablewright.llm import arrays, decontaminate

from ..conftest import SF001
from . import edge


def _brute(docs, items, threshold):
    """Every item-sized window of every document against every item."""
    found = {}
    words = lambda t: decontaminate._word_hashes(next(arrays.blocks(pa.array([t or ""]))))[0]
    bags = [(i, len(words(t)), decontaminate.bag(words(t))) for i, t in items]
    for d, t in docs:
        w = words(t)
        for i, n, bag in bags:
            for lo in range(max(1, len(w) - n + 1)) if n else ():
                s = decontaminate.similarity(decontaminate.bag(w[lo:lo + n]), bag)
                if s >= threshold:
                    found[d, i] = max(found.get((d, i), 0), round(s, 6))
    return found


def test_every_window_over_the_threshold_is_found(spark):
    items = [r for r in map(tuple, spark.read.parquet(f"{SF001}/benchmark.parquet").collect())][:6]
    filler = ["alpha beta gamma delta " * 4, "x y z " * 10]
    docs, n = [], 0
    for _, text in items:
        w = text.split()
        variants = [text, text.upper(), " ".join(w[1:]), " ".join(w[:-2]), text.replace(" ", ", ")]
        variants.append(" ".join([*w[:5], "changed", *w[6:]]))  # one word replaced
        variants.append(" ".join([*w[:9], "put", "in", *w[9:]]))  # two words put in
        variants.append(" ".join(w[:len(w) // 2]))
        for v in variants:
            docs.append((n, f"{filler[n % 2]}{v} {filler[(n + 1) % 2]}"))
            n += 1
    got = decontaminate.find_leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    assert {(r.doc_id, r.item_id): r.similarity for r in got} == _brute(docs, items, 0.8)


def test_blocks_of_items_give_the_same(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    items = spark.read.parquet(f"{SF001}/benchmark.parquet")
    one = sorted(decontaminate.find_leaks(docs, items).collect())
    assert one and one == sorted(decontaminate.find_leaks(docs, items, words_at_once=500).collect())
    kept = decontaminate.decontaminate(docs, items)
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in kept.collect()} == {r.doc_id for r in one}


def test_an_index_too_large_to_send_gives_the_same(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    items = spark.read.parquet(f"{SF001}/benchmark.parquet")
    sent = sorted(decontaminate.find_leaks(docs, items).collect())
    monkeypatch.setattr(decontaminate, "INDEX_BYTES", 0)
    assert sent and sorted(decontaminate.find_leaks(docs, items).collect()) == sent


def test_one_pass_serves_many_items(spark, monkeypatch):
    """The same rows whatever the number of other items, and the documents read once for all."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{SF001}/benchmark.parquet").select("item_id", "text")
    few = sorted(decontaminate.find_leaks(docs, items).collect())
    more = spark.range(10_000).selectExpr(
        "100000 + id AS item_id",
        "concat_ws(' ', transform(sequence(1, 12), i -> concat('z', cast(xxhash64(id, i) % 100000 AS string)))) AS text",
    )
    passes = []
    real = decontaminate._fingerprint
    monkeypatch.setattr(decontaminate, "_fingerprint", lambda *a: passes.append(1) or real(*a))
    assert sorted(decontaminate.find_leaks(docs, items.union(more)).collect()) == few and len(passes) == 1


def test_block_index_finds_every_fingerprint_within_the_radius(spark):
    rng = np.random.default_rng(3)
    prints = rng.integers(0, 256, (5, 16)).astype(np.uint8)
    items = {"ids": list(range(5)), "prints": list(prints), "bags": [(np.ones(1), np.ones(1))] * 5}
    rows = []
    for n in range(5):
        for bits in (0, 7, 39, 40, 41, 60):
            flip = np.zeros(128, np.uint8)
            flip[rng.choice(128, bits, replace=False)] = 1
            rows.append((len(rows), 0, 1, (prints[n] ^ np.packbits(flip)).tolist(), [1], [1]))
    windows = spark.createDataFrame(
        rows, "id long, start long, words long, print array<int>, items array<long>, weights array<long>"
    )
    from tablewright.llm.work import work_dir

    got = {(r.id, r.item) for r in decontaminate._within_radius(windows, items, 40, work_dir(spark)).collect()}
    far = lambda p, q: int(np.unpackbits(np.array(p, np.uint8) ^ q).sum())
    assert got == {(r[0], n) for r in rows for n in range(5) if far(r[3], prints[n]) <= 40}


def test_edge_cases(spark):
    items = spark.createDataFrame(
        [(1, None), (2, ""), (3, "short"), (4, "one two three four five six seven"), (4, "one two three four five six seven")],
        "item_id long, text string",
    )
    docs = edge.table(spark)
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, items).collect()}
    assert got == {(4, 4), (5, 4), (6, 3), (None, 4)}
    assert decontaminate.find_leaks(docs, items.where("false")).collect() == []
    assert decontaminate.find_leaks(edge.empty(spark), items).collect() == []
    assert decontaminate.decontaminate(docs, items).count() == len(edge.ROWS) - 4  # a row without an id stays


def test_reordered_parts_and_items_of_few_words_are_found(spark):
    words = [f"w{n}" for n in range(60)]
    items = [(1, " ".join(words)), (2, "q1 q2 q3"), (3, "single"), (4, "a b c d e f g h"), (5, "r s t u v " * 4)]
    swapped = " ".join(words[30:] + words[:30])
    thirds = " ".join(words[40:] + words[20:40] + words[:20])  # three parts: 48 of 56 shingles, below 0.8
    docs = [
        (1, swapped), (2, f"x y z {swapped} x y z"), (3, thirds), (4, f"before Q1, q2 q3 after q1 q2 q3 {swapped}"),
        (5, "q1 q2"), (6, "q1 q2 q3"), (7, "many a single word, single again"), (8, "q1 q2 x q3"), (9, None), (10, ""),
        (11, "x " * 7 + "a b c d e f g h" + " x" * 7), (12, "r s t u v " * 9), (13, "single"),
    ]
    got = decontaminate.find_leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    found = {(r.doc_id, r.item_id): r.similarity for r in got}
    assert found == _brute(docs, items, 0.8)
    assert {k for k in found if k[1] == 1} == {(1, 1), (2, 1), (4, 1)}
    assert {k for k in found if k[1] in (2, 3)} == {(4, 2), (6, 2), (7, 3), (13, 3)}
    assert next(r.start_word for r in got if (r.doc_id, r.item_id) == (4, 2)) == 1
