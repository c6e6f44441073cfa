"""Conversation structure repair: generalised LR parsing with weighted edits.

A conversation is a sequence of rows, read by the first letter of their roles. A
repair makes that sequence a sentence of the role grammar ``(s?(ua)+)?`` at the
least cost: a row is kept (0), gets another role (3) or is deleted (4, the only
choice for blank and duplicate rows), and rows without text are inserted (3); a
truncated row that stays costs 3 more. Of the cheapest repairs the one whose
audit (initials of its edits in order) is ASCII-least counts.

The parser is a table-driven LR automaton made from ``RULES``. Its stacks form a
graph: a cell is (state, cell below) and exists once, so alternatives share what
they have in common. All repairs of a conversation advance together, row by row;
of those that reach the same stack top only the one with the least (cost, audit)
stays. Audits of one level never are prefixes of each other, so a rank within the
level stands for the whole audit, and a level with its relative costs is one of
few that are ever met: its successor is looked up, not computed again.

A conversation of any length is cut into blocks of ``BLOCK_ROWS`` rows. A block
is parsed from every stack top it can be entered with (from the empty stack if it
begins its conversation); what meets for one conversation is a few numbers for
each block, which ``_chain`` joins in order. Only symbols (one character a row)
are parsed; texts are sorted once and joined with their edits once.

Defined results: a null role or text reads as one space; null turns come first;
rows of one turn are ordered by role and text; a null id is a conversation of its
own. Rows repeated in every column are one row and its duplicates. A role that
starts with no letter of the grammar can only be re-roled or deleted. Extra
columns are ignored. An empty table gives empty tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache, lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.work import small_batches, work_dir, written

# The role grammar: left-recursive, so that no stack grows with its conversation.
RULES = (("S", ()), ("S", ("H",)), ("H", ("H", "u", "a")), ("H", ("u", "a")), ("H", ("s", "u", "a")))
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLOCK_BITS = 16
BLOCK_ROWS = 1 << BLOCK_BITS
# A script has one letter for each edit: K keep, D delete, U and A re-role to user
# and assistant, v and b insert user and assistant. Its audit has the initials.
INSERTS, REROLES = {"u": "v", "a": "b"}, {"u": "U", "a": "A"}
SCRIPT_LETTERS, AUDIT_LETTERS = "vbUA", "IIRR"
# Symbols: the role's initial (x: any other), upper case if truncated; digits for rows that must go.
INITIALS, BLANK, DUPLICATE = "suax", "1234", "5678"
_INITIAL = {c: i for s in (INITIALS, INITIALS.upper(), BLANK, DUPLICATE) for c, i in zip(s, INITIALS, strict=True)}
LEGAL = frozenset(("su", "ua", "au"))
_WORD = r"[^\x20\x09-\x0D]"


# ---------------------------------------------------------------------------
# the LR automaton and its stack graph


class _Table:
    """States (sets of rule, dot), transitions and follow sets of a grammar, by SLR construction."""

    def __init__(self, rules):
        self.rules = (("^", (rules[0][0],)), *rules)
        names = {left for left, _ in self.rules}
        follow = {n: {"$"} if n in ("^", rules[0][0]) else set() for n in names}
        for _ in self.rules:
            for left, right in self.rules:
                for i, x in enumerate(right):
                    if x in names:
                        follow[x] |= self._first(right[i + 1]) if i + 1 < len(right) else follow[left]
        self.follow, self.states, self.goto = follow, [self._closure({(0, 0)})], {}
        for i, state in enumerate(self.states):
            for x in sorted({self.rules[r][1][d] for r, d in state if d < len(self.rules[r][1])}):
                to = self._closure({(r, d + 1) for r, d in state if self.rules[r][1][d:d + 1] == (x,)})
                if to not in self.states:
                    self.states.append(to)
                self.goto[i, x] = self.states.index(to)

    def _first(self, x) -> set:
        heads = [right[0] for left, right in self.rules if left == x and right and right[0] != x]
        return set().union(*map(self._first, heads)) if heads else {x}

    def _closure(self, items) -> frozenset:
        items = set(items)
        while more := {
            (k, 0) for r, d in items for k, (left, _) in enumerate(self.rules) if self.rules[r][1][d:d + 1] == (left,)
        } - items:
            items |= more
        return frozenset(items)

    def reduction(self, state: int, ahead: str | None):
        """The rule to reduce by; without a look-ahead only where nothing else can follow."""
        done = [r for r, d in self.states[state] if d == len(self.rules[r][1])]
        if ahead is None:
            return done[0] if len(done) == len(self.states[state]) == 1 and done[0] else None
        return next((r for r in done if ahead in self.follow[self.rules[r][0]]), None)


class Stacks:
    """The stack graph: cell 0 is the empty stack, a cell is (state, cell below) and exists once."""

    def __init__(self, rules=RULES):
        self.table = _Table(rules)
        self.cells: list[tuple[int, int]] = [(0, 0)]
        self.shift = cache(self._shift)
        self.closes = cache(self._closes)

    def _push(self, cell: int, state: int) -> int:
        if (state, cell) not in self.cells[1:]:
            self.cells.append((state, cell))
        return self.cells.index((state, cell), 1)

    def _reduce(self, cell: int, rule: int) -> int:
        left, right = self.table.rules[rule]
        for _ in right:
            cell = self.cells[cell][1]
        return self._push(cell, self.table.goto[self.cells[cell][0], left])

    def _shift(self, cell: int, symbol: str) -> int | None:
        """The top after shifting ``symbol``; none if the grammar doesn't allow it there."""
        while (to := self.table.goto.get((self.cells[cell][0], symbol))) is None:
            if (rule := self.table.reduction(self.cells[cell][0], symbol)) is None:
                return None
            cell = self._reduce(cell, rule)
        cell = self._push(cell, to)
        while (rule := self.table.reduction(self.cells[cell][0], None)) is not None:
            cell = self._reduce(cell, rule)
        return cell

    def _closes(self, cell: int) -> bool:
        """Whether a conversation may end here."""
        while rule := self.table.reduction(self.cells[cell][0], "$"):
            cell = self._reduce(cell, rule)
        return (0, 1) in self.table.states[self.cells[cell][0]]

    def tops(self) -> list[int]:
        """All stack tops that a row can be read at."""
        found = [0]
        for cell in found:
            found += sorted({c for x in INITIALS if (c := self.shift(cell, x)) is not None} - {*found})
        return found


class Repairer:
    """Least (cost, audit) repairs. A level is ((cell, relative cost), ...), its audits ascending."""

    def __init__(self):
        self.stacks = Stacks()
        self.stacks.tops()  # numbers the cells alike in all tasks
        self.step = cache(self._step)
        self.lone = lru_cache(100_000)(self._lone)

    def _inserted(self, level) -> dict:
        """cell -> (cost, rank, audit, script) before the next row, any number of rows inserted."""
        reach = {cell: (cost, rank, "", "") for rank, (cell, cost) in enumerate(level)}
        todo = [*reach]
        while todo:
            cost, rank, audit, script = reach[cell := todo.pop()]
            for role, letter in INSERTS.items():
                to, way = self.stacks.shift(cell, role), (cost + INSERT, rank, audit + "I", script + letter)
                if to is not None and (to not in reach or way[:3] < reach[to][:3]):
                    reach[to] = way
                    todo.append(to)
        return reach

    def _step(self, level, symbol: str):
        """The next level, what its least cost adds, and for each of its cells (rank before, script)."""
        best: dict[int, tuple] = {}
        role, stays = _INITIAL[symbol], not symbol.isdigit()
        more = TRUNCATED if symbol.isupper() else 0
        for cell, (cost, rank, audit, script) in self._inserted(level).items():
            ways = [(cell, cost + DELETE, "D", "D")]
            if stays:
                ways.append((self.stacks.shift(cell, role), cost + KEEP + more, "K", "K"))
                ways += [(self.stacks.shift(cell, r), cost + REROLE + more, "R", x) for r, x in REROLES.items()]
            for to, total, a, s in ways:
                way = (total, rank, audit + a, script + s)
                if to is not None and (to not in best or way[:3] < best[to][:3]):
                    best[to] = way
        order = sorted(best, key=lambda c: best[c][1:3])
        least = min(way[0] for way in best.values())
        return tuple((c, best[c][0] - least) for c in order), least, tuple((best[c][1], best[c][3]) for c in order)

    def close(self, level) -> tuple[int, int, str]:
        """(cost, rank, script) of the best end."""
        ends = [way for cell, way in self._inserted(level).items() if self.stacks.closes(cell)]
        cost, rank, _, script = min(ends, key=lambda way: way[:3])
        return cost, rank, script

    def run(self, symbols: str, entry: int = 0):
        """Level, cost and back pointers after all symbols, entered at a stack top."""
        level, cost, backs = ((entry, 0),), 0, []
        for symbol in symbols:
            level, more, back = self.step(level, symbol)
            cost += more
            backs.append(back)
        return level, cost, backs

    @staticmethod
    def script(backs, rank: int) -> str:
        parts = []
        for back in reversed(backs):
            rank, part = back[rank]
            parts.append(part)
        return "".join(reversed(parts))

    def _lone(self, symbols: str) -> tuple[int, str]:
        """Cost and script of a whole conversation."""
        level, cost, backs = self.run(symbols)
        more, rank, tail = self.close(level)
        return cost + more, self.script(backs, rank) + tail

    def block(self, symbols: str, first: bool) -> list[tuple[int, int, int, int, str]]:
        """(entry, exit, cost, rank, script) of every way through a block."""
        out = []
        for entry in [0] if first else self.stacks.tops():
            level, cost, backs = self.run(symbols, entry)
            out += [(entry, c, cost + more, rank, self.script(backs, rank)) for rank, (c, more) in enumerate(level)]
        return out


def illegal_pairs(symbols: str) -> int:
    initials = [_INITIAL[c] for c in symbols]
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))


# ---------------------------------------------------------------------------
# tasks


_BLOCKS = (
    "row_id long, entry int, exit int, cost long, rank int, script string, illegal long, first string, last string"
)
_CHAINED = "row_id long, entry int, exit int, cost long, illegal long, tail string"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ways through each block; of a conversation that is one block only the best, closed."""
    repairer = Repairer()
    for batch in batches:
        ids, rows = [], []
        blocks = zip(*(batch.column(c).to_pylist() for c in ("row_id", "symbols", "head", "tail")), strict=True)
        for i, (row_id, symbols, head, tail) in enumerate(blocks):
            if head == tail:
                cost, script = repairer.lone(symbols) if len(symbols) <= 64 else repairer._lone(symbols)
                ways = [(0, None, cost, 0, script)]
            else:
                ways = repairer.block(symbols, row_id == head)
            illegal = illegal_pairs(symbols)
            for way in ways:
                ids.append(i)
                rows.append((row_id, *way, illegal, symbols[0], symbols[-1]))
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.string()]
        columns = [*zip(*rows, strict=True)] or [()] * len(types)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id").take(pa.array(ids, pa.int64())), *map(pa.array, columns, types)],
            names=["conv_id", *(c.split()[0] for c in _BLOCKS.split(", "))],
        )


def _chain(table: pa.Table) -> pa.Table:
    """The way through each block of one conversation: a few numbers a block, no scripts."""
    repairer = Repairer()
    blocks: dict[int, list[dict]] = {}
    for r in table.drop_columns("conv_id").to_pylist():
        blocks.setdefault(r["row_id"], []).append(r)
    level, total, backs, before = ((0, 0),), 0, [], ""
    illegal = []
    for row_id in sorted(blocks):
        ranks = {cell: (rank, cost) for rank, (cell, cost) in enumerate(level)}
        best: dict[int, tuple] = {}
        for r in blocks[row_id]:
            if r["entry"] in ranks:
                rank, cost = ranks[r["entry"]]
                way = (cost + r["cost"], rank, r["rank"], r["entry"])
                if r["exit"] not in best or way < best[r["exit"]]:
                    best[r["exit"]] = way
        order = sorted(best, key=lambda c: best[c][1:3])
        least = min(way[0] for way in best.values())
        level, total = tuple((c, best[c][0] - least) for c in order), total + least
        backs.append((row_id, [(best[c][1], best[c][3], c) for c in order]))
        first = blocks[row_id][0]
        illegal.append(first["illegal"] + bool(before and _INITIAL[before] + _INITIAL[first["first"]] not in LEGAL))
        before = first["last"]
    more, rank, tail = repairer.close(level)
    out = []
    for i in range(len(backs) - 1, -1, -1):
        row_id, ways = backs[i]
        rank, entry, leave = ways[rank]
        last = i == len(backs) - 1
        out.append((row_id, entry, leave, total + more if last else 0, illegal[i], tail if last else ""))
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
    return pa.Table.from_arrays(
        [table.column("conv_id").slice(0, 1).take(pa.array([0] * len(out))), *map(pa.array, zip(*out, strict=True), types)],
        names=["conv_id", *(c.split()[0] for c in _CHAINED.split(", "))],
    )


def _hash_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the newline-joined lines of each conversation, fed line by line (rows sorted)."""
    state, key, schema = None, None, None

    def row():
        return pa.RecordBatch.from_arrays([key, pa.array([state.hexdigest()])], names=["conv_id", "sha256"])

    for batch in batches:
        ids, lines = batch.column("conv_id"), batch.column("line").to_pylist()
        values = ids.to_pylist()
        for i, line in enumerate(lines):
            if state is None or values[i] != schema:
                if state is not None:
                    yield row()
                state, key, schema = hashlib.sha256(), ids.slice(i, 1), values[i]
            else:
                state.update(b"\n")
            state.update(line.encode())
    if state is not None:
        yield row()


# ---------------------------------------------------------------------------
# the operator


def damage(conversations: DataFrame) -> DataFrame:
    """The rows with the contract's damage, chosen by crc32 of ``conv_id:turn``; nulls read as one space."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(text_of("text"), ".!?", "")).otherwise(text_of("text"))
    role = F.when(kind == 4, "user").otherwise(text_of("role"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return conversations.where(kind != 0).select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_copy")
    ).drop("_copy")


def _symbol(initial: Column, blank: Column, duplicate: Column, truncated: Column) -> Column:
    return (
        F.when(blank, F.translate(initial, INITIALS, BLANK))
        .when(duplicate, F.translate(initial, INITIALS, DUPLICATE))
        .when(truncated, F.upper(initial))
        .otherwise(initial)
    )


class Repair(NamedTuple):
    """``rows``: conv_id, row_id, step, role, text, edit of the repaired rows, in the order of (row_id, step).
    ``conversations``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit (one row each)."""

    rows: DataFrame
    conversations: DataFrame


def _ordered(rows: DataFrame, folder: str) -> DataFrame:
    """All rows in the order of their conversations; ``row_id`` counts up within each.

    The order is spread by sampled ranges, so a long conversation lies on several
    tasks; rows equal in all columns may be parted by the salt.
    """
    order = ["conv_id", "turn", "role", "text"]
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text"))
    initial = F.substring("role", 1, 1)
    ordered = (
        rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role, text)
        .withColumn("_salt", F.rand(17))
        .repartitionByRange(*order, "_salt")
        .sortWithinPartitions(*order)
        .select(
            F.monotonically_increasing_id().alias("row_id"), *order,
            F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"),
            (~F.col("text").rlike(_WORD)).alias("blank"),
            (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("truncated"),
            F.md5(F.concat(F.length("role"), F.lit(":"), "role", "text")).alias("digest"),
        )
    )
    return written(ordered, folder, "ordered")


def _blocks(ordered: DataFrame, folder: str) -> DataFrame:
    """``conv_id, row_id`` (the first one's) and ``symbols`` of blocks of rows; head and tail of the conversation."""
    seen = ordered.where("NOT blank").groupBy("conv_id", "digest").agg(F.min("row_id").alias("seen"))
    marked = ordered.join(seen.select("seen"), F.col("row_id") == F.col("seen"), "left")
    symbol = _symbol(F.col("initial"), F.col("blank"), F.col("seen").isNull(), F.col("truncated"))
    blocks = (
        marked.select("conv_id", "row_id", symbol.alias("symbol"))
        .groupBy("conv_id", F.shiftright("row_id", BLOCK_BITS).alias("block"))
        .agg(F.array_sort(F.collect_list(F.struct("row_id", "symbol"))).alias("rows"))
        .select("conv_id", F.col("rows")[0]["row_id"].alias("row_id"), F.array_join("rows.symbol", "").alias("symbols"))
    )
    blocks = written(blocks, folder, "blocks")
    span = blocks.groupBy(F.col("conv_id").alias("_conv")).agg(F.min("row_id").alias("head"), F.max("row_id").alias("tail"))
    return blocks.join(span, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")


def repair(rows: DataFrame) -> Repair:
    """The least-cost repair of every conversation of ``conv_id, turn, role, text``."""
    spark = rows.sparkSession
    small_batches(spark)
    folder = work_dir(spark)
    ordered = _ordered(rows, folder)
    blocks = _blocks(ordered, folder)
    kind = ordered.schema["conv_id"].dataType.simpleString()
    ways = written(blocks.mapInArrow(_parse, f"conv_id {kind}, {_BLOCKS}"), folder, "ways")
    lone = ways.where("exit IS NULL").select("conv_id", "row_id", "cost", "illegal", "script")
    chained = ways.where("exit IS NOT NULL").drop("script").groupBy("conv_id").applyInArrow(
        _chain, f"conv_id {kind}, {_CHAINED}"
    )
    long_ = chained.join(ways.select("row_id", "entry", "exit", "script"), ["row_id", "entry", "exit"]).select(
        "conv_id", "row_id", "cost", "illegal", F.concat("script", "tail").alias("script")
    )
    best = written(lone.unionByName(long_), folder, "best")

    pieces = F.regexp_extract_all("script", F.lit(r"[vb]*[UAKD](?:[vb]*\z)?"), 0)
    edits = best.select("row_id", F.posexplode(pieces).alias("_i", "piece")).select(
        (F.col("row_id") + F.col("_i")).alias("row_id"), "piece"
    )
    role = lambda x: (
        F.when(x == "K", F.col("role")).when(x.isin("U", "v"), "user").otherwise("assistant")
    )
    lines = F.transform(
        F.split("piece", ""),
        lambda x, i: F.struct(
            i.alias("step"), role(x).alias("role"), F.when(x.isin("v", "b"), "").otherwise(F.col("text")).alias("text"),
            F.translate(x, SCRIPT_LETTERS, AUDIT_LETTERS).alias("edit"),
        ),
    )
    repaired = (
        ordered.select("conv_id", "row_id", "role", "text")
        .join(edits.where("piece <> 'D'"), "row_id")
        .select("conv_id", "row_id", F.explode(F.filter(lines, lambda x: x["edit"] != "D")).alias("x"))
        .select("conv_id", "row_id", "x.*")
    )

    turns = ordered.where("turn IS NOT NULL").select("conv_id", "turn").distinct().groupBy("conv_id").agg(
        F.expr("try_cast(cast(max(turn) AS decimal(38,0)) - min(turn) + 1 - count(*) AS bigint)").alias("gaps")
    )
    symbols = F.col("symbols")
    count = lambda letters: F.length(symbols) - F.length(F.translate(symbols, letters, ""))
    faults = blocks.select(
        "conv_id", count(BLANK).alias("blank"), count(DUPLICATE).alias("duplicate"), count(INITIALS.upper()).alias("truncated")
    )
    parts = best.select(
        "conv_id", "cost", "illegal", F.struct("row_id", "script").alias("part")
    ).unionByName(faults, allowMissingColumns=True).unionByName(turns, allowMissingColumns=True)
    scripts = F.array_sort(F.collect_list("part"))
    total = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    audit = F.translate(F.array_join(scripts["script"], ""), SCRIPT_LETTERS, AUDIT_LETTERS)
    return Repair(repaired, parts.groupBy("conv_id").agg(*total, audit.alias("audit")))


def digests(rows: DataFrame) -> DataFrame:
    """``conv_id, sha256`` of the repaired rows (``role:text`` joined by newlines).

    A digest is a chain over its conversation, so the lines of one pass one task,
    sorted and one by one; nothing is gathered.
    """
    small_batches(rows.sparkSession)
    kind = rows.schema["conv_id"].dataType.simpleString()
    return (
        rows.repartition("conv_id")
        .sortWithinPartitions("conv_id", "row_id", "step")
        .select("conv_id", F.concat("role", F.lit(":"), "text").alias("line"))
        .mapInArrow(_hash_lines, f"conv_id {kind}, sha256 string")
    )


def repair_report(conversations: DataFrame) -> DataFrame:
    """The contract's row for each original ``conv_id`` of the damaged conversations."""
    found = repair(damage(conversations))
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    parts = (
        conversations.select("conv_id")
        .distinct()
        .unionByName(found.conversations, allowMissingColumns=True)
        .unionByName(digests(found.rows), allowMissingColumns=True)
    )
    return parts.groupBy("conv_id").agg(
        *(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in names),
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("sha256"), F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
