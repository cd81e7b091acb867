"""Conversation structure repair by weighted interval parsing.

A conversation's roles are to read ``(s?(ua)+)?``. With the states of that expression as i, j, k, the
repair grammar in Chomsky normal form has a symbol A_ij for "leads from i to j", rules
A_ij -> A_ik A_kj, and for each row what keeping, relabelling or deleting it leads to, after the
fewest insertions that lead to where it fits (the insertion closure). A cell holds the least
(cost, audit) of its span for each symbol. All rows of a span have one letter each and insertions
stand before a row's letter, so no audit of a cell begins with another one: least parts make least
wholes. As every symbol of a span can be cut at any place of the span, one cut serves: spans of 1, 2, 4, ...
rows are combined bottom-up, and a long conversation's spans may come from different tasks.

Rows are sorted over all partitions by conversation and turn, whatever the conversations' sizes. One that
lies inside a partition is repaired there. Those that a partition border cuts (and very long
ones) go through a second pass: repetitions are marked by a salted join, the spans of each
partition are parsed, spans are joined, and a last streaming pass writes what the audit says.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache, reduce
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import settle, small

BLANKS = " \t\n\x0b\x0c\r"
STOPS = ".!?"
RELABEL, DELETE, INSERT, UNMENDED = 3, 4, 3, 3

# States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NEXT = {0: "u", 1: "u", 2: "a", 3: "u"}  # the letter that an insertion or a new label has
ROLE = {"u": "user", "a": "assistant"}
#: Fewest insertions from one state to another.
CLOSURE = {(0, 0): 0, (0, 2): 1, (0, 3): 2, (1, 1): 0, (1, 2): 1, (1, 3): 2, (2, 2): 0, (2, 3): 1, (3, 3): 0, (3, 2): 1}
ENDS = {0: 0, 1: 2, 2: 1, 3: 0}  # insertions from a state to the nearest end
PAIRS = [(i, j) for i in range(4) for j in range(4) if i == j or (j > 1 and i != j) or (i, j) == (0, 1)]
RULES = [((i, j), (i, k), (k, j)) for i, j in PAIRS for k in range(4) if (i, k) in PAIRS and (k, j) in PAIRS]

Cells = dict[tuple[int, int], tuple[int, str]]

GOOD, BLANK, DUPLICATE, TRUNCATED = range(4)
COLUMNS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


@dataclass(frozen=True)
class Params:
    most_rows: int = 4096  # of a conversation that is repaired in one go
    most_chars: int = 8 << 20
    salts: int = 16


@lru_cache
def leaf(letter: str, fault: int) -> Cells:
    """The cells of one row, given its role's first letter and its fault."""
    out: Cells = {}

    def offer(i: int, j: int, cost: int, audit: str) -> None:
        out[i, j] = min(out.get((i, j), (cost, audit)), (cost, audit))

    more = UNMENDED if fault == TRUNCATED else 0
    for (i, m), n in CLOSURE.items():
        offer(i, m, n * INSERT + DELETE, "I" * n + "D")
        if fault not in (BLANK, DUPLICATE):
            if (m, letter) in STEP:
                offer(i, STEP[m, letter], n * INSERT + more, "I" * n + "K")
            offer(i, STEP[m, NEXT[m]], n * INSERT + RELABEL + more, "I" * n + "R")
    return out


def joined(left: Cells, right: Cells) -> Cells:
    """The cells of two neighbouring spans together."""
    out: Cells = {}
    for whole, first, second in RULES:
        x, y = left.get(first), right.get(second)
        if x is None or y is None:
            continue
        cost, old = x[0] + y[0], out.get(whole)
        if old is None or cost < old[0]:
            out[whole] = (cost, x[1] + y[1])
        elif cost == old[0]:
            out[whole] = min(old, (cost, x[1] + y[1]))
    return out


def finished(cells: Cells) -> tuple[int, str]:
    """The least cost and audit of a whole conversation, insertions at its end included."""
    return min((cells[0, j][0] + n * INSERT, cells[0, j][1] + "I" * n) for j, n in ENDS.items() if (0, j) in cells)


@dataclass
class Span:
    """What is known of a run of rows: counts, ends, and the cells of finished pieces, the longest first."""

    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first: str | None = None
    last: str | None = None
    low: int | None = None  # turns come in order, so the ends tell how many there are
    high: int | None = None
    turns: int = 0
    pieces: list[tuple[int, Cells]] = field(default_factory=list)

    def add(self, turn: int | None, letter: str, fault: int) -> None:
        self.blank += fault == BLANK
        self.duplicate += fault == DUPLICATE
        self.truncated += fault == TRUNCATED
        if self.first is None:
            self.first = letter
        else:
            self.illegal += self.last + letter not in ("su", "ua", "au")
        self.last = letter
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        self.pieces.append((1, leaf(letter, fault)))
        while len(self.pieces) > 1 and self.pieces[-1][0] == self.pieces[-2][0]:
            n, right = self.pieces.pop()
            _, left = self.pieces.pop()
            self.pieces.append((2 * n, joined(left, right)))

    def cells(self) -> Cells:
        return reduce(lambda right, left: joined(left, right), [c for _, c in reversed(self.pieces)]) if self.pieces else {(i, i): (0, "") for i in range(4)}

    def then(self, other: Span) -> Span:
        """Both spans as one; the cells of each are in one piece."""
        if other.first is None:
            return self
        if self.first is None:
            return other
        return Span(
            self.blank + other.blank, self.duplicate + other.duplicate, self.truncated + other.truncated,
            self.illegal + other.illegal + (self.last + other.first not in ("su", "ua", "au")), self.first, other.last,
            other.low if self.low is None else self.low, self.high if other.high is None else other.high,
            self.turns + other.turns - (self.high is not None and self.high == other.low), [(1, joined(self.cells(), other.cells()))])

    def result(self) -> tuple:
        """The columns of ``COLUMNS``; zeros and an empty audit without rows."""
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, *finished(self.cells()))


def rewritten(rows: Iterable[tuple[str, str]], audit: str) -> Iterator[str]:
    """The lines that the audit makes of the rows (role, text)."""
    rows, state = iter(rows), 0
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        state = STEP[state, role[0] if letter == "K" else NEXT[state]]
        yield f"{role if letter == 'K' else ROLE['a' if state == 3 else 'u']}:{text}"


def digest(lines: Iterable[str]) -> str:
    made = hashlib.sha256()
    for k, line in enumerate(lines):
        made.update(("\n" * (k > 0) + line).encode())
    return made.hexdigest()


def repaired(rows: list[tuple[int | None, str, str]]) -> tuple:
    """The columns of ``COLUMNS`` and the digest, of a conversation's rows (turn, role, text) in order."""
    span, seen = Span(), set()
    for turn, role, text in rows:
        core = text.strip(BLANKS)
        fault = BLANK if not core else DUPLICATE if (role, text) in seen else TRUNCATED if core[-1] not in STOPS else GOOD
        seen.add((role, text))
        span.add(turn, role[:1], fault)
    out = span.result()
    return (*out, digest(rewritten([r[1:] for r in rows], out[-1])))


def damaged(conversations: DataFrame) -> DataFrame:
    """(name, conv_id, turn, role, text, tie, gone): the rows after damage, those that are dropped marked ``gone``.

    Nulls count as one blank; ``name`` tells conversations apart, ``tie`` orders rows of one turn.
    """
    def said(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), said("role").alias("role"), said("text").alias("text"))
    rows = rows.withColumn("name", said("conv_id")).withColumn("_how", F.crc32(F.concat("name", F.lit(":"), said("turn")).cast("binary")) % 20)
    text = F.when(F.col("_how") == 1, "").when(F.col("_how") == 2, F.translate("text", STOPS, "")).otherwise(F.col("text"))
    rows = rows.select(
        "name", "conv_id", "turn", F.when(F.col("_how") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        (F.col("_how") == 0).alias("gone"), F.explode(F.array_repeat(F.lit(0), F.when(F.col("_how") == 3, 2).otherwise(1))).alias("_copy"))
    return rows.withColumn("tie", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))).drop("_copy")


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            yield from zip(*[c.to_pylist() for c in batch.slice(at, 512).columns], strict=True)


def _whole(p: Params):
    """For sorted rows: the result of each conversation of the partition, ``open`` where it may not be all of it."""
    def made(name: str, rows: Iterator[tuple]) -> dict:
        kept, chars, conv_id, long = [], 0, None, False
        for _, conv_id, turn, role, text, gone in rows:
            if gone or long:
                continue
            kept.append((turn, role, text))
            chars += len(role) + len(text)
            if len(kept) > p.most_rows or chars > p.most_chars:
                long, kept = True, []
        names = [c.split()[0] for c in COLUMNS.split(",")] + ["repaired_sha256"]
        return {"name": name, "conv_id": conv_id, "open": long, "long": long} | dict(zip(names, repaired(kept), strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("name", pa.string()), ("conv_id", pa.int64()), ("open", pa.bool_()), ("long", pa.bool_()),
                            *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                            ("audit", pa.string()), ("repaired_sha256", pa.string())])
        out, first = [], True
        for name, rows in groupby(_in_order(batches), lambda r: r[0]):
            if len(out) >= 1024:
                yield pa.RecordBatch.from_pylist(out[:-1], schema)
                out = out[-1:]
            out.append(made(name, rows))
            out[-1]["open"] |= first
            first = False
        if out:
            out[-1]["open"] = True
        yield pa.RecordBatch.from_pylist(out, schema)

    return run


_SPAN = ("name string, blank long, duplicate long, truncated long, illegal long, first string, last string, low long, high long, turns long, "
         "cells array<struct<i:int,j:int,cost:long,audit:string>>")


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For sorted rows (name, turn, letter, fault): one row for each conversation of the partition."""
    cell = pa.struct([("i", pa.int32()), ("j", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
    counts = ("blank", "duplicate", "truncated", "illegal")
    schema = pa.schema([("name", pa.string()), *[(c, pa.int64()) for c in counts], ("first", pa.string()), ("last", pa.string()),
                        *[(c, pa.int64()) for c in ("low", "high", "turns")], ("cells", pa.list_(cell))])
    for name, rows in groupby(_in_order(batches), lambda r: r[0]):
        span = Span()
        for _, turn, letter, fault in rows:
            span.add(turn, letter, fault)
        cells = [{"i": i, "j": j, "cost": c, "audit": a} for (i, j), (c, a) in span.cells().items()]
        yield pa.RecordBatch.from_pylist([{"name": name, "cells": cells} | {c: getattr(span, c) for c in schema.names[1:-1]}], schema)


def _combined(group: pd.DataFrame) -> pd.DataFrame:
    """The result of one conversation from its spans, one for each partition that held some of it."""
    def number(x):
        return None if pd.isna(x) else int(x)

    whole = Span()
    for r in group.sort_values("part").itertuples():
        cells = {(c["i"], c["j"]): (c["cost"], c["audit"]) for c in r.cells}
        whole = whole.then(Span(r.blank, r.duplicate, r.truncated, r.illegal, r.first, r.last, number(r.low), number(r.high), r.turns, [(1, cells)]))
    return pd.DataFrame([(group.name.iloc[0], *whole.result())], columns=["name", *[c.split()[0] for c in COLUMNS.split(",")]])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each conversation's audit and then its rows in order: the digest, one row held at a time."""
    for name, rows in groupby(_in_order(batches), lambda r: r[0]):
        audit = next(rows)[2]
        made = digest(rewritten((r[1:] for r in rows), audit))
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([made])], names=["name", "repaired_sha256"])


def _cut(rows: DataFrame, names: DataFrame, p: Params) -> DataFrame:
    """The results of the conversations ``names`` (name, conv_id) of ``rows``, however long each is."""
    order = [F.col("name"), F.col("turn").asc_nulls_first(), F.col("tie"), F.col("place")]
    rows = settle(rows.where("not gone").join(names.select("name"), "name", "left_semi").withColumn("place", F.monotonically_increasing_id()), "cut-rows")
    at = F.struct(F.coalesce("turn", F.lit(-(1 << 63))), "place")
    repeated = rows.groupBy("name", "tie").agg(F.min(at).alias("first"), F.count("*").alias("n")).where("n > 1").select("name", "tie", "first")
    repeated = settle(repeated, "repeated").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(p.salts - 1))))
    core = F.btrim(F.col("text"), F.lit(BLANKS))
    thin = rows.select("name", "turn", "tie", "place", F.substring("role", 1, 1).alias("letter"), at.alias("at"), (core == "").alias("blank"),
                       F.substring(core, -1, 1).isin(*STOPS).alias("stops"), F.pmod("place", F.lit(p.salts)).cast("int").alias("salt"))
    thin = thin.join(repeated, ["name", "tie", "salt"], "left")
    fault = F.when(F.col("blank"), BLANK).when(F.col("at") > F.col("first"), DUPLICATE).when(~F.col("stops"), TRUNCATED).otherwise(GOOD)
    thin = thin.select("name", "turn", "tie", "place", "letter", fault.alias("fault"))
    spans = thin.repartitionByRange(*order).sortWithinPartitions(*order).select("name", "turn", "letter", "fault").mapInArrow(_spans, _SPAN)
    spans = settle(spans.withColumn("part", F.spark_partition_id()), "spans")
    found = settle(spans.groupBy("name").applyInPandas(_combined, f"name string, {COLUMNS}"), "combined")
    lines = rows.select("name", "turn", "tie", "place", "role", "text", F.lit(1).alias("kind")).unionByName(found.select(
        "name", F.lit(None).cast("long").alias("turn"), F.lit("").alias("tie"), F.lit(-1).cast("long").alias("place"), F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(0).alias("kind")))
    lines = lines.repartition("name").sortWithinPartitions("name", "kind", *order[1:]).select("name", "role", "text")
    made = names.join(found, "name", "left").join(lines.mapInArrow(_digests, "name string, repaired_sha256 string"), "name", "left")
    # one whose rows are all dropped has none of these
    return made.fillna(0).fillna("", ["audit"]).fillna(digest([]), ["repaired_sha256"]).withColumn("conv_id", F.when(F.col("name") != " ", F.col("conv_id")))


def repair(conversations: DataFrame, p: Params = Params()) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of each conversation after damage.

    Rows are taken by turn, nulls first, those of one turn in the order of a digest of role and
    text; repeated rows are rows each. Rows without conv_id make one conversation. A null role or
    text is one blank; an empty role has no letter and can only be relabelled. Equal role and text
    are told by their MD5 where a conversation lies in several partitions. An empty table gives an
    empty result.
    """
    rows = damaged(conversations.select("conv_id", "turn", "role", "text"))
    order = [F.col("name"), F.col("turn").asc_nulls_first(), F.col("tie")]
    # equal rows are spread, too
    dealt = rows.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(*order, F.col("place")).sortWithinPartitions(*order)
    found = dealt.select("name", "conv_id", "turn", "role", "text", "gone").mapInArrow(
        _whole(p), f"name string, conv_id long, open boolean, long boolean, {COLUMNS}, repaired_sha256 string")
    found = settle(found, "repaired")
    cut = found.where("open").groupBy("name").agg(F.first("conv_id").alias("conv_id"), F.count("*").alias("n"), F.max("long").alias("long"))
    cut = settle(cut.where("n > 1 or long").select("name", "conv_id"), "cut")
    columns = ["conv_id", *[c.split()[0] for c in COLUMNS.split(",")], "repaired_sha256"]
    whole = found.join(small(cut.select("name")), "name", "left_anti").select(*columns)
    return whole.unionByName(_cut(rows, small(cut), p).select(*columns))


def op13_repair(spark, sf_dir: str) -> DataFrame:
    """Every conversation damaged and repaired."""
    return repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
