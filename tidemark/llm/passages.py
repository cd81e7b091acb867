"""Repeated passages by sparse suffix arrays.

Of each text only the suffixes at minimisers are kept: in every window of as many consecutive
k-word grams as fit into the least passage, the gram of the smallest hash. Two copies of a
passage of that length choose the same place. Suffixes whose first gram occurs once in the corpus
cannot match and go. The others are sorted by what follows them, and once more by what
precedes them (read backwards); neighbours are compared and their match is extended to both
sides. A match that reaches the least length is a repeated passage; longer ones are the union of
the matches at several minimisers.

Neighbours show the longest match to the right, and the longest to the left, that a suffix has
with any other. Where one match is both, or each reaches the least length, nothing else can
add to them; where the two together could but neither does alone, a third suffix in between
may. The grams of such suffixes are looked at again, all windows around them by their hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents, settle
from tidemark.llm.grams import mix, word_hashes

_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Params:
    least: int = 50  # words of a passage
    gram: int = 8  # words

    @property
    def window(self) -> int:
        return self.least - self.gram + 1


def minimisers(words: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """Places and gram hashes: the leftmost smallest of every window."""
    size = len(words) - p.gram + 1
    if size < p.window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    rolled = np.zeros(size, np.uint64)
    for j in range(p.gram):
        rolled = rolled * _STEP + words[j : j + size]
    grams = mix(rolled)
    view = np.lib.stride_tricks.sliding_window_view(grams, p.window)
    places = np.unique(np.concatenate([view[k : k + 4096].argmin(axis=1) + np.arange(k, min(k + 4096, len(view)))
                                       for k in range(0, len(view), 4096)]))
    return places, grams[places]


def _anchors(p: Params):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part, n, found = batch.slice(at, 512), [], []
                for words in word_hashes(part.column(2).to_pylist()):
                    n.append(len(words))
                    places, grams = minimisers(words, p)
                    found.append([{"place": int(a), "gram": int(g)} for a, g in zip(places, grams.astype(np.int64), strict=True)])
                kind = pa.list_(pa.struct([("place", pa.int32()), ("gram", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(found, kind)],
                    names=["doc_id", "text_key", "n_words", "anchors"])

    return run


def _contexts(p: Params):
    """The words from each place on, and those before it backwards, as 32-bit hashes in sortable bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                keys, places = part.column(0).to_pylist(), part.column(1)
                out = {"gram": [], "after": [], "before": [], "text_key": [], "place": []}
                for row, words in enumerate(word_hashes(part.column(2).to_pylist())):
                    short = ((words >> np.uint64(32)).astype(np.uint32) | np.uint32(1)).astype(">u4")
                    room = np.zeros(p.least, ">u4")
                    padded = np.concatenate([room, short, room])
                    view = np.lib.stride_tricks.sliding_window_view(padded, p.least)
                    for k in places[row].as_py():
                        after, before = view[k + p.least], view[k][::-1]
                        out["after"].append(after.tobytes())
                        out["before"].append(before.tobytes())
                        out["gram"].append(after[: p.gram].tobytes())
                        out["text_key"].append(keys[row])
                        out["place"].append(k)
                kinds = (pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], names=list(out))

    return run


PAIRS = "text_key long, place int, gram long, before_words int, after_words int, after binary, before binary"


def _compare(p: Params):
    """For each row and its neighbours: the words they share before and after the place.

    The first and last row of a partition are passed on, with their contexts, for another turn.
    """
    columns = [c.split()[0] for c in PAIRS.split(", ")]

    def common(packed: list[bytes]) -> np.ndarray:
        codes = np.frombuffer(b"".join(packed), ">u4").reshape(-1, p.least)
        return np.cumprod((codes[1:] == codes[:-1]) & (codes[1:] != 0), axis=1).sum(axis=1)

    def matches(rows: pd.DataFrame) -> pd.DataFrame:
        same = np.flatnonzero(rows.gram.to_numpy()[1:] == rows.gram.to_numpy()[:-1])
        right, left = common(list(rows.after))[same], common(list(rows.before))[same]
        made = rows[["text_key", "place", "gram"]].iloc[np.concatenate([same, same + 1])]
        made = made.assign(before_words=np.tile(left, 2), after_words=np.tile(right, 2))
        return made.drop_duplicates().reindex(columns=columns)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, edges = None, []
        for part in parts:
            if not len(part):
                continue
            if last is None:
                edges.append(part.iloc[:1])
            rows = part if last is None else pd.concat([last, part])
            last = part.iloc[-1:]
            if len(rows) > 1:
                yield matches(rows)
        if last is not None:
            yield pd.concat([*edges, last]).reindex(columns=columns)

    return run


def _neighbours(contexts: DataFrame, order: list[str], p: Params) -> DataFrame:
    """(text_key, place, gram, before_words, after_words) of neighbours in the order of ``order``.

    Range partitions spread a gram that is everywhere by what surrounds it. The two rows at
    each partition's ends, a handful for the whole table, are sorted and compared once more.
    """
    sort = ["gram", *order, "text_key", "place"]
    dealt = contexts.repartitionByRange(*sort).sortWithinPartitions(*sort)
    made = settle(dealt.mapInPandas(_compare(p), PAIRS), "neighbours")
    edges = made.where("before_words is null").select(contexts.columns).coalesce(1).sortWithinPartitions(*sort)
    more = edges.mapInPandas(_compare(p), PAIRS)
    return made.unionByName(more).where("before_words is not null").drop("after", "before")


def _windows(p: Params):
    """The hash of every window of the least length around a place's gram, and where it starts."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers = _STEP ** np.arange(2 * p.least, dtype=np.uint64)
        back = np.uint64(pow(int(_STEP), -1, 1 << 64)) ** np.arange(2 * p.least, dtype=np.uint64)
        for part in parts:
            for at in range(0, len(part), 2048):
                rows = part.iloc[at : at + 2048]
                before, after = (np.frombuffer(b"".join(rows[c]), ">u4").reshape(-1, p.least) for c in ("before", "after"))
                codes = np.concatenate([before[:, ::-1], after], axis=1)
                sums = np.zeros((len(rows), 2 * p.least + 1), np.uint64)
                np.cumsum(mix(codes.astype(np.uint64)) * powers, axis=1, out=sums[:, 1:])
                first = p.least - np.arange(p.window)  # a window holds the whole gram
                hashes = mix((sums[:, first + p.least] - sums[:, first]) * back[first])
                whole = (codes[:, first] != 0) & (codes[:, first + p.least - 1] != 0)
                row, k = np.nonzero(whole)
                yield pd.DataFrame({"window": hashes[row, k].astype(np.int64), "text_key": rows.text_key.to_numpy()[row],
                                    "start": rows.place.to_numpy()[row].astype(np.int64) - k})

    return run


def _matched(contexts: DataFrame, p: Params) -> DataFrame:
    """(text_key, start, stop) of all matches of the least length between two places."""
    near = _neighbours(contexts, ["after", "before"], p).unionByName(_neighbours(contexts, ["before", "after"], p))
    enough = F.col("before_words") + F.col("after_words") >= p.least
    spans = near.where(enough).select(
        "text_key", (F.col("place") - F.col("before_words")).cast("long").alias("start"),
        (F.col("place") + F.col("after_words")).cast("long").alias("stop")).distinct()
    best = near.groupBy("text_key", "place", "gram").agg(
        F.max("before_words").alias("before"), F.max("after_words").alias("after"),
        F.coalesce(F.max(F.when(enough, F.col("before_words"))), F.lit(-1)).alias("before_held"),
        F.coalesce(F.max(F.when(enough, F.col("after_words"))), F.lit(-1)).alias("after_held"))
    open_ = (F.col("before") + F.col("after") >= p.least) & ((F.col("before") != F.col("before_held")) | (F.col("after") != F.col("after_held")))
    again = contexts.join(settle(best.where(open_).select("gram").distinct(), "open"), "gram")
    windows = settle(again.mapInPandas(_windows(p), "window long, text_key long, start long").distinct(), "windows")
    twice = windows.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
    more = windows.join(twice, "window").select("text_key", "start", (F.col("start") + p.least).alias("stop"))
    return spans.unionByName(more)


def _merge(rows: pd.Series) -> pd.Series:
    """Sorted spans, those that touch or overlap made one; none of a null list."""
    out = []
    for spans in rows:
        done: list[dict] = []
        for start, stop in sorted((s["start"], s["stop"]) for s in (spans if spans is not None else ())):
            if done and start <= done[-1]["stop"]:
                done[-1]["stop"] = max(done[-1]["stop"], stop)
            else:
                done.append({"start": start, "stop": stop})
        out.append(done)
    return pd.Series(out)


def repeated_passages(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, n_words, n_repeated and spans (word numbers, end excluded) for every row of ``docs``.

    A passage counts as repeated if its words occur at another place too, in this text or
    another. A text that several rows hold is repeated as a whole if it is long enough. Null and
    short texts have no spans; a row without an id takes part like any other.
    """
    rows = settle(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text").mapInArrow(
        _anchors(p), "doc_id long, text_key long, n_words long, anchors array<struct<place:int,gram:long>>"), "anchors")
    texts = rows.where(F.size("anchors") > 0).groupBy("text_key").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id")).alias("one"), F.count("*").alias("copies"),
        F.first("n_words").alias("n_words"), F.first("anchors").alias("anchors"))
    texts = settle(texts.select("text_key", "one.doc_id", "copies", "n_words", "anchors"), "texts")
    places = texts.select("text_key", F.explode("anchors").alias("a")).select("text_key", "a.place", "a.gram")
    # written first, so that a join that finds a gram everywhere can split it
    shared = settle(places.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"), "shared")
    wanted = places.join(shared, "gram").groupBy("text_key").agg(F.sort_array(F.collect_list("place")).alias("places"))
    wanted = settle(wanted.join(texts.select("text_key", "doc_id"), "text_key").select("text_key", F.col("doc_id").alias("_id"), "places"), "places")
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("_key"), "text")
    found = keyed.join(wanted, (F.col("_key") == F.col("text_key")) & F.col("doc_id").eqNullSafe(F.col("_id"))).select("text_key", "places", "text")
    made = found.mapInArrow(_contexts(p), "gram binary, after binary, before binary, text_key long, place int")
    contexts = settle(made.withColumn("gram", F.xxhash64("gram")).distinct(), "contexts")
    spans = _matched(contexts, p)
    whole = texts.where(F.col("copies") > 1).select("text_key", F.lit(0).cast("long").alias("start"), F.col("n_words").alias("stop"))
    lists = spans.unionByName(whole).distinct().groupBy("text_key").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    merged = F.pandas_udf(_merge, "array<struct<start:long,stop:long>>")
    lists = settle(lists.select("text_key", merged(F.col("spans")).alias("spans")), "spans")
    none = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    made = rows.drop("anchors").join(lists, "text_key", "left").withColumn("spans", F.coalesce("spans", none))
    words = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return made.select("doc_id", "n_words", words.alias("n_repeated"), "spans")


def op4_passages(spark, sf_dir: str) -> DataFrame:
    """For every document, how many of its words lie in passages of 50 words and more that repeat."""
    made = repeated_passages(documents(spark, sf_dir).select("doc_id", "text"))
    return made.select("doc_id", "n_words", "n_repeated", F.size("spans").alias("n_passages"))
