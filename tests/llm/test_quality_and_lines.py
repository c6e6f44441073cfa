import re
from collections import Counter

from pyspark.sql import functions as F

from tablewright.llm import line_dedup, quality_rules

from . import brute, edge


def _measures(text):
    words = brute.words(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    n = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if n[w] > 1 for j in range(5)}
    lines = [x for x in (text or "").split("\n") if brute.words(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)), len(covered),
    )


def test_measures_match_brute_force(spark):
    texts = [None, "", "a b c d e f a b c d e", "x\nx\n x\n\n\n", "q " * 30, "é日 #$\né日 #$", edge.LONG, "a b\x0bc\x0cd"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
           for r in quality_rules.measure(df).collect()}
    assert got == {i: _measures(t) for i, t in enumerate(texts)}


def test_ledger_policies_and_ablations(spark):
    rows = quality_rules.ledger(quality_rules.measure(edge.table(spark))).cache()
    assert rows.count() == len(edge.ROWS)
    long_ = rows.where("doc_id = 7").first()
    assert long_.failures & quality_rules.mask_of(["repeated_windows"])
    report = {r.rule: r for r in quality_rules.ablations(rows).collect()}
    kept = rows.where(~quality_rules.fails(quality_rules.CURRENT)).count()
    for name, r in report.items():
        others = quality_rules.mask_of([n for n in quality_rules.POLICIES[quality_rules.CURRENT] if n != name])
        without = rows.where(F.col("failures").bitwiseAND(F.lit(others)) == 0).count()
        assert (r.documents, r.kept, r.kept_without) == (len(edge.ROWS), kept, without)
    assert quality_rules.measure(edge.empty(spark)).collect() == []


def _lines_brute(rows, ratio, least):
    pages, total = Counter(), Counter()
    for _, host, text in rows:
        total[host] += 1
        for line in {x.strip(" \t\n\x0b\x0c\r") for x in (text or "").split("\n")} - {""}:
            pages[host, line] += 1
    bad = {k for k, n in pages.items() if n >= least and n / total[k[0]] > ratio}
    out = []
    for d, host, text in rows:
        if text is None:
            out.append((d, None, 0, 0))
            continue
        lines = text.split("\n")
        keep = [x for x in lines if (host, x.strip(" \t\n\x0b\x0c\r")) not in bad]
        out.append((d, "\n".join(keep), len(lines), len(lines) - len(keep)))
    return sorted(out, key=str)


def test_lines_match_brute_force(spark):
    rows = [(i, "h1" if i % 3 else None, f"menu\nbody {i}\n  menu \n\nfooter {i % 2}") for i in range(40)]
    rows += [(50, "h1", None), (51, "h1", ""), (52, "h2", "menu\nbody"), (53, "h1", "menu\nmenu"), (53, "h1", "menu\nmenu")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = line_dedup.drop_boilerplate_lines(df, ratio=0.3, min_pages=5).collect()
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got), key=str) == _lines_brute(rows, 0.3, 5)


def test_the_ratio_alone_decides_on_small_hosts(spark):
    rows = [(i, "four", f"menu\nbody {i}\n{'pair' if i < 2 else 'other'}") for i in range(4)] + [(9, "one", "menu\nbody 1")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = {r.doc_id: r.text for r in line_dedup.drop_boilerplate_lines(df, counts=False).collect()}
    assert got == {**{i: f"body {i}" for i in range(4)}, 9: "menu\nbody 1"}


def test_line_edge_cases(spark):
    got = line_dedup.drop_boilerplate_lines(edge.table(spark), counts=False)
    assert got.columns == edge.table(spark).columns
    want = _lines_brute([(r[0], r[3], r[1]) for r in edge.ROWS], line_dedup.RATIO, line_dedup.MIN_PAGES)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(((d, t) for d, t, *_ in want), key=str)
    assert line_dedup.drop_boilerplate_lines(edge.empty(spark)).collect() == []
