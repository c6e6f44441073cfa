import itertools
import random

import pytest

from tablewright.llm import conversations

from ..conftest import SF01
from . import brute

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def _got(df):
    rows = conversations.repair_report(df).collect()
    out = {r.conv_id: tuple(r[n] for n in NAMES) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query_matches_brute_force(spark):
    df = spark.read.parquet(f"{SF01}/conversations.parquet")
    assert _got(df) == brute.repair_report([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_random_conversations_match_brute_force(spark):
    rng = random.Random(3)
    roles, texts = ["user", "assistant", "system", "tool", "", None, "User"], ["a.", "b", " \t", "", None, "c! \n", "d?x", "é日."]
    rows = [
        (conv, rng.choice([None, *range(12)]), rng.choice(roles[:2] if rng.random() < 0.7 else roles), rng.choice(texts) if rng.random() < 0.5 else f"t{i}.")
        for conv in [None, *range(150)] for i in range(rng.randrange(14))
    ]
    rows += rng.sample(rows, 60)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1L AS row_id", "'x' AS symbol", "2 AS cost")
    assert _got(df) == brute.repair_report(rows)


def test_least_cost_of_all_edit_sequences():
    """Every sequence of edits on up to three rows, by plain enumeration."""
    import re

    repairer = conversations.Repairer()
    for n in range(4):
        for symbols in itertools.product("suaxSU15", repeat=n):
            best = None
            slots = [["", "v", "b", "vb", "bv", "vv", "bb", "vbv", "bvb"]] * (n + 1)
            for edits in itertools.product("KDUA", repeat=n):
                if any(s.isdigit() and e != "D" for s, e in zip(symbols, edits, strict=True)):
                    continue
                for ins in itertools.product(*(slots if n < 3 else [x[:5] for x in slots])):
                    script = "".join(i + e for i, e in zip(ins, [*edits, ""], strict=True))
                    marks = iter(symbols)
                    roles, cost = "", 0
                    for e in script:
                        s = next(marks) if e in "KDUA" else ""
                        cost += {"K": 0, "D": 4}.get(e, 3) + (3 if s.isupper() and e != "D" else 0)
                        roles += s.lower() if e == "K" else {"D": "", "U": "u", "A": "a", "v": "u", "b": "a"}[e]
                    if re.fullmatch(r"(s?(ua)+)?", roles):
                        way = (cost, script.translate(str.maketrans("vbUA", "IIRR")), script)
                        best = way if best is None else min(best, way)
            assert repairer.lone("".join(symbols)) == (best[0], best[2])


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_long_conversations_are_joined_from_blocks(spark, monkeypatch, bits):
    monkeypatch.setattr(conversations, "BLOCK_BITS", bits)
    rng = random.Random(bits)
    rows = [
        (conv, i, rng.choice(["user", "assistant", "assistant", "system", "tool"]), rng.choice(["x.", "y", "", f"t{i}!", f"z{i}"]))
        for conv in (1, 2, None) for i in range(60)
    ]
    assert _got(spark.createDataFrame(rows, SCHEMA)) == brute.repair_report(rows)


def test_repaired_rows_are_legal_and_edits_explain_them(spark):
    rows = [(1, i, "user", f"text {i}.") for i in range(5)] + [(2, 0, "assistant", "a."), (3, 0, "system", "s.")]
    found = conversations.repair(spark.createDataFrame(rows, SCHEMA))
    got = [(r.conv_id, r.role, r.text, r.edit) for r in found.rows.orderBy("conv_id", "row_id", "step").collect()]
    assert [x[1] for x in got if x[0] == 1] == ["user", "assistant"] * 3
    assert {(r.conv_id, r.cost, r.audit) for r in found.conversations.collect()} >= {(2, 3, "IK"), (3, 4, "D")}
    assert [x[1:] for x in got if x[0] == 2] == [("user", "", "I"), ("assistant", "a.", "K")]


def test_empty_long_and_dropped(spark):
    assert _got(spark.createDataFrame([], SCHEMA)) == {}
    dropped = next(c for c in range(1000) if brute.damaged([(c, 0, "user", "x.")]) == [])
    rows = [(dropped, 0, "user", "x."), (7, 5, "user", "word " * 100_000 + "."), (7, 6, "assistant", "ok.")]
    got = _got(spark.createDataFrame(rows, SCHEMA))
    assert got == brute.repair_report(rows)
    assert got[dropped] == (0, 0, 0, 0, 0, 0, "", "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855")
