import pytest

from tablewright.llm import licenses, mixing
from tablewright.llm.license_texts import KNOWN

from ..conftest import SF001
from . import brute, edge


def test_known_texts_are_found_in_other_spellings(spark):
    mit = next(t for i, k, t in KNOWN if i == "MIT" and k == "text")
    rows = [
        (1, mit), (2, "Copyright (c) 2020 Someone\n\n" + mit.upper()), (3, mit.replace('"', "'").replace(",", " ;")),
        (4, mit.replace("sublicense", "sublicence")), (5, mit + " More."), (6, "text\nReleased under the MIT licence!\nmore"),
        (7, "text\n\n# " + mit.replace("\n\n", "\n") + "\n\nmore"), (8, None), (9, ""), (10, "the software"), (6, "x"),
    ]
    got = {(r.doc_id, r.license_id, r.unit): r.n_matches
           for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k for k in got if k[2] == "document"} == {(d, "MIT", "document") for d in (1, 2, 3, 4)}
    assert got[6, "MIT", "line"] == 1 and got[7, "MIT", "paragraph"] == 1
    assert not any(k[0] in (5, 8, 9, 10) for k in got)
    assert licenses.scan_licenses(edge.empty(spark)).collect() == []
    assert licenses.scan_licenses(edge.table(spark)).collect() == []


def test_titles_and_copyright_lines_of_real_files(spark):
    mit = next(t for i, k, t in KNOWN if i == "MIT" and k == "text")
    bsd = next(t for i, k, t in KNOWN if i == "BSD-2-Clause")
    heads = [
        "", "MIT License\n\nCopyright (c) 2020 Someone\n\n", "(c) Jane Doe\n\n", "The MIT License (MIT)\n\n",
        "MIT License\n\nCopyright (c) [year] [fullname]\n\n", "# The MIT License\n\nCopyright Jane Doe and the ACME Contributors\n\n"
        .replace("ACME", "Acme"), "© ACME Inc.\n\n", "Copyright (c) <year> <copyright holders>\n\n",
    ]
    rows = [(i, h + mit) for i, h in enumerate(heads)]
    rows += [(20, 'BSD 2-Clause "Simplified" License\n\nCopyright (c) 2001, A\nAll rights reserved.\n\n' + bsd), (21, "MIT License"),
             (22, "A tale\n\n" + mit.replace("free of charge", "for a fee"))]
    got = {r.doc_id: r.license_id for r in
           licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).where("unit = 'document'").collect()}
    assert got == {**{i: "MIT" for i in range(len(heads))}, 20: "BSD-2-Clause"}


def test_long_texts_by_digest(spark):
    """Whole texts that stand on this machine, as they are and wrapped anew in capitals."""
    import re
    from pathlib import Path

    folder, rows, want = Path("/usr/share/common-licenses"), [], {}
    names = {"GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "Apache-2.0": "Apache-2.0", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    for i, (name, license_id) in enumerate(names.items()):
        if (folder / name).exists():
            text = (folder / name).read_text()
            rows += [(2 * i, text), (2 * i + 1, re.sub(r"[ \t]+", "  ", text).upper())]
            want |= {2 * i: license_id, 2 * i + 1: license_id}
    if not rows:
        pytest.skip("no licence texts here")
    got = {r.doc_id: r.license_id for r in
           licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).where("unit = 'document'").collect()}
    assert got == want


def test_own_texts_without_a_marker_are_still_found(spark):
    got = licenses.scan_licenses(edge.table(spark), known=[("own", "line", "One, two, three four five six seven")], full=()).collect()
    assert sum(r.n_matches for r in got) == 4


def _water(sizes, epochs=3, weights=(1, 2, 3)):
    """The repetition of the definition: share by weight, clamp, share the excess again."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > epochs * sizes[s]}
        if not over:
            target.update({s: left * weight[s] / total for s in free})
            break
        for s in over:
            target[s] = float(epochs * sizes[s])
            left -= target[s]
        free -= over
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 5, None: 300}, {"a": 0, "b": 7}, {"x": 1}, {"a": 1, "b": 1, "c": 1, "d": 1000, "e": 50},
])
def test_targets_match_the_repeated_sharing(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    want = _water(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_mix_takes_its_targets_and_reruns_agree(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = mixing.mix(docs).collect()
    assert sorted(got) == sorted(mixing.mix(docs.repartition(7)).collect())
    text = {r.doc_id: (r.text, r.source) for r in docs.collect()}
    taken, target = {}, {}
    for r in got:
        assert r.size == len(brute.words(text[r.doc_id][0])) and 0 <= r.taken <= 3 * r.size
        source = text[r.doc_id][1]
        taken[source] = taken.get(source, 0) + r.taken
        target[source] = r.target
    assert all(abs(taken[s] - target[s]) <= 25 for s in target)


def test_mix_edge_cases(spark):
    got = mixing.mix(edge.table(spark)).collect()
    assert len(got) == len(edge.ROWS)
    assert all(r.taken == 0 for r in got if r.doc_id in (1, 2, 3))
    assert mixing.mix(edge.empty(spark)).collect() == []
    assert mixing.mix_documents(edge.empty(spark)).collect() == []
    rows = mixing.mix_documents(edge.table(spark))
    assert rows.columns == [*edge.table(spark).columns, "repetition", "words_taken"]
    assert sum(r.words_taken for r in rows.collect()) == sum(r.taken for r in got)


def test_a_hot_source_gives_its_target_only(spark):
    rows = [(i, f"w{i} " * (5 + i % 9), "hot" if i % 3 else ("a", "b", None)[i % 9 // 3]) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = {(r.source, r.target) for r in mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id").select("source", "target").collect()}
    got = {r.source: r.n for r in mixing.mix_documents(docs).groupBy("source").sum("words_taken").toDF("source", "n").collect()}
    assert all(abs(got[s] - t) <= 25 for s, t in want) and len(want) == 4
    assert mixing.mix_documents(docs).select("doc_id").distinct().count() < 3000
