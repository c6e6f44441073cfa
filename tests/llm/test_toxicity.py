import numpy as np

from tablewright.llm import toxicity

from ..conftest import SF01
from . import brute, edge


def test_held_out_accuracy_and_contract(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.score_documents(docs, model).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == brute.held_out(d) for d, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    tested = [(r.toxic, got[r.doc_id]) for r in labels.collect() if got[r.doc_id].held_out]
    assert sum(t == s.predicted for t, s in tested) / len(tested) >= 0.9
    toxic = [s.score for t, s in tested if t]
    clean = [s.score for t, s in tested if not t]
    assert np.mean([a > b for a in toxic for b in clean]) >= 0.95  # area under the curve
    # a label of the held-out fold changes nothing
    flipped = labels.selectExpr(
        "doc_id", "CASE WHEN crc32(cast(doc_id AS string)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic"
    )
    again = toxicity.fit(docs, flipped)
    assert (again.gram_llr == model.gram_llr).all() and (again.weights == model.weights).all()


def test_edge_cases(spark):
    docs = edge.table(spark)
    labels = spark.createDataFrame([(4, 1), (6, 0), (99, 1), (2, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = toxicity.score_documents(docs, model).collect()
    assert len(got) == len(edge.ROWS) and all(0 <= r.score <= 1 for r in got)
    none = toxicity.fit(docs, labels.where("false"))
    assert {r.score for r in toxicity.score_documents(docs, none).collect()} == {0.0}
    assert toxicity.keep_ordinary(docs, none).count() == len(edge.ROWS)
    assert toxicity.keep_ordinary(edge.empty(spark), none).columns == docs.columns
    assert toxicity.score_documents(edge.empty(spark), none).collect() == []


def test_ngrams_hold_each_byte_and_those_before_it():
    packed, owner = toxicity.ngrams([b"ab", b"c"])
    raw = [int(x).to_bytes(8, "big") for x in packed]
    assert raw == [b"\1" * 7 + b"a", b"\1" * 6 + b"ab", b"\1" * 5 + b"ab\2", b"\1" * 7 + b"c", b"\1" * 6 + b"c\2"]
    assert owner.tolist() == [0, 0, 0, 1, 1]


def test_probabilities_after_a_context_sum_to_one():
    """Seen bytes and the mass left to the backoff, with the backoff a distribution itself."""
    words = [b"abba", b"abab", b"baba", b"aa", b"b"]
    packed, _ = toxicity.ngrams(words)
    grams, counts = np.unique(packed, return_counts=True)
    backoff = toxicity.shared_backoff(grams)
    assert ((backoff > 0) & (backoff <= 1)).all()
    _, llr, _, rest = toxicity.fit_counts(grams, counts, counts)
    assert np.allclose(llr, 0) and np.allclose(rest, 0)  # equal models tell nothing


def _plain_models(grams, toxic, ordinary):
    """Interpolated Kneser-Ney by its definition, on byte strings: p(class, context, byte)."""
    from collections import Counter, defaultdict

    n, d = toxicity.ORDER, toxicity.DISCOUNT
    top = [Counter(dict(zip(grams, c, strict=True))) for c in (toxic, ordinary)]
    lower, types = {}, set(grams)
    for order in range(n - 1, 0, -1):
        cut = Counter(g[1:] for g in types)  # distinct bytes before
        table = defaultdict(dict)
        for g, c in cut.items():
            table[g[:-1]][g[-1:]] = c
        lower[order], types = table, set(cut)

    def shared(order, context, byte):
        if order == 0:
            return 1 / 256
        seen = lower[order].get(context)
        back = shared(order - 1, context[1:], byte)
        if not seen:
            return back
        total = sum(seen.values())
        return max(seen.get(byte, 0) - d, 0) / total + d * len(seen) / total * back

    def p(which, context, byte):
        seen = {g[-1:]: c for g, c in top[which].items() if g[:-1] == context and c}
        back = shared(n - 1, context[1:], byte)
        if not seen:
            return back
        total = sum(seen.values())
        return max(seen.get(byte, 0) - d, 0) / total + d * len(seen) / total * back

    return p


def test_probabilities_match_the_definition_and_sum_to_one():
    words = [b"abba", b"abab", b"baba", b"aa", b"b", b"abbot", b"cab"]
    packed, _ = toxicity.ngrams(words)
    grams = np.unique(packed)
    rng = np.random.default_rng(4)
    toxic, ordinary = rng.integers(0, 4, len(grams)), rng.integers(0, 4, len(grams))
    toxic[(toxic == 0) & (ordinary == 0)] = 1
    raw = [int(g).to_bytes(8, "big") for g in grams]
    p = _plain_models(raw, toxic.tolist(), ordinary.tolist())
    for which in (0, 1):
        for context in {g[:-1] for g in raw} | {b"unseen!"}:
            assert abs(sum(p(which, context, bytes([b])) for b in range(256)) - 1) < 1e-12
    found, llr, contexts, rest = toxicity.fit_counts(grams, toxic, ordinary)
    for g, value in zip(found, llr, strict=True):
        r = int(g).to_bytes(8, "big")
        want = np.log(p(0, r[:-1], r[-1:])) - np.log(p(1, r[:-1], r[-1:]))
        assert abs(value - want) < 1e-5
    # a byte never seen after a context: what the two classes leave to the shared backoff
    for c, value in zip(contexts, rest, strict=True):
        r = int(c).to_bytes(7, "big")
        assert abs(value - (np.log(p(0, r, b"~")) - np.log(p(1, r, b"~")))) < 1e-5


def test_sample_is_bounded_by_bytes_and_takes_whole_texts(spark):
    docs = spark.createDataFrame([(i, ("bad " if i % 2 else "good ") * 50) for i in range(200)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 AS int) AS toxic")
    from tablewright.llm.work import work_dir

    rows, totals = toxicity._training(docs, labels, "doc_id", "text", "toxic", work_dir(spark), 1000, 2000)
    got = rows.groupBy("toxic").agg({"text": "count"}).collect()
    assert {r.toxic: r[1] for r in got} == {0: 8, 1: 10} and sum(totals.values()) > 100
    one, _ = toxicity._training(docs, labels, "doc_id", "text", "toxic", work_dir(spark), 1000, 1)
    assert one.count() == 2 and {len(r.text) for r in one.collect()} == {200, 250}
    model = toxicity.fit(docs, labels, max_bytes=2000)
    assert all(r.predicted == r.doc_id % 2 for r in toxicity.score_documents(docs, model).collect())


def test_tied_and_repeated_labels(spark):
    """The larger of several labels of one document counts, however often each is there."""
    docs = spark.createDataFrame([(i, ("bad " if i % 2 else "good ") * 20) for i in range(60)], "doc_id long, text string")
    once = docs.selectExpr("doc_id", "cast(doc_id % 2 AS int) AS toxic")
    more = once.union(once.selectExpr("doc_id", "0")).union(once)
    a, b = toxicity.fit(docs, once), toxicity.fit(docs, more)
    assert a.prior == b.prior and (a.gram_llr == b.gram_llr).all() and (a.weights == b.weights).all()


def test_scores_do_not_move_with_the_row_bound(spark, monkeypatch):
    """Below the class counts, the bound changes neither the prior nor the scores of clean text."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    empty = edge.table(spark).where("doc_id = 2")

    def run():
        model = toxicity.fit(docs, labels)
        got = {r.doc_id: r.score for r in toxicity.score_documents(docs, model).collect()}
        clean = [got[r.doc_id] for r in labels.collect() if r.toxic == 0 and brute.held_out(r.doc_id)]
        return toxicity.score_documents(empty, model).first().score, np.array(clean)

    prior, clean = run()
    monkeypatch.setattr(toxicity, "MAX_ROWS", 250)
    bounded_prior, bounded = run()
    assert bounded_prior == prior
    assert abs(bounded.mean() - clean.mean()) < 0.02
