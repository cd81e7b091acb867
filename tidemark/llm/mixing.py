"""Mixing sources to target weights by distributed prefix sums.

Every row gets a hash-random key. Rows are dealt to ranges of the key within their source, as
many ranges as the source needs; sums per range are few rows, and their running sum says in
which range the source's budget ends. Only that range is sorted, which gives the key of the
cut. Whole repetitions of a source (epochs) need no order at all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORDS, documents, settle, small


@dataclass(frozen=True)
class Params:
    """Sources in code-point order, null last, weigh ``weights`` in turn; each is taken ``most`` times at most."""

    weights: tuple[int, ...] = (1, 2, 3)
    most: int = 3
    range_rows: int = 4096  # about, of one source in one range
    seed: str = "mix"


def count_words(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, WORDS))).cast("long")


def random_key(doc_id: Column, size: Column, seed: str) -> Column:
    """32 hexadecimal digits that depend on the id, or without one on the size, and the seed."""
    return F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), size.cast("string")))


def budgets(sizes: DataFrame, p: Params) -> DataFrame:
    """(source, source_size, ranges, target, epochs, rest) from rows (source, size).

    The targets share the whole by weight under a ceiling: a source whose ceiling comes first
    when all grow in step stops there, the others share what is left. With sources in the order
    of ceiling over weight, the level is found from running sums. One row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    every = Window.partitionBy(F.lit(0))
    order = every.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, p.weights)), ((F.row_number().over(order) - 1) % len(p.weights) + 1).cast("int"))
    rows = per.withColumn("weight", weight.cast("long")).withColumn("ceiling", F.col("source_size") * p.most)
    full = every.orderBy(F.col("ceiling") / F.col("weight"), F.col("source").asc_nulls_last())
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({
        "left": F.sum("source_size").over(every) - F.coalesce(F.sum("ceiling").over(before), F.lit(0)),
        "open": F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
    })
    # whether this source and all after it stay under their ceilings when they share what is left
    fits = F.col("ceiling") * F.col("open") >= F.col("left") * F.col("weight")
    rows = rows.withColumn("level", F.min(F.when(fits, F.struct((-F.col("open")).alias("place"), "left", "open"))).over(every))
    left, open_ = F.col("level.left"), F.col("level.open")
    target = F.when(
        left.isNull() | (F.col("ceiling") * open_ <= left * F.col("weight")), F.col("ceiling").cast("double")
    ).otherwise((left * F.col("weight")) / open_)
    rows = rows.withColumn("target", target).withColumn("whole", F.round("target").cast("long"))
    rows = rows.withColumn("epochs", F.when(F.col("source_size") == 0, F.lit(0)).otherwise(F.expr("whole div source_size")))
    return rows.select(
        "source", "source_size", F.ceil(F.col("n") / p.range_rows).cast("long").alias("ranges"), "target",
        F.col("epochs").cast("long").alias("epochs"),
        (F.col("whole") - F.col("epochs") * F.col("source_size")).cast("long").alias("rest"))


def cuts(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """One row per source of ``docs`` (doc_id, source, size): its target and where it is cut.

    Each row is taken ``epochs`` times, and once more if its key is below ``cut_key``; of a row
    whose key is the cut itself, ``share`` words more are taken.
    """
    keyed = settle(docs.select("source", "size", random_key(F.col("doc_id"), F.col("size"), p.seed).alias("key")), "sizes")
    plan = small(budgets(keyed, p))
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * F.col("ranges")
    rows = keyed.withColumnRenamed("source", "_source").join(plan, F.col("_source").eqNullSafe(F.col("source"))).withColumn(
        "part", F.shiftright(place, 32))
    sums = rows.groupBy("source", "part").agg(F.sum("size").alias("part_size"), F.first("rest").alias("rest"))
    running = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    found = sums.withColumn("begins", F.coalesce(F.sum("part_size").over(running), F.lit(0)))
    found = found.where("begins < rest and rest <= begins + part_size")  # at most one range of each source
    found = small(found.select(F.col("source").alias("_cut"), F.col("part").alias("_part"), "begins"))
    inside = rows.join(found, F.col("_cut").eqNullSafe(F.col("source")) & (F.col("_part") == F.col("part")))
    keys = inside.groupBy("source", "key").agg(
        F.sum("size").alias("key_size"), F.count("*").alias("ties"), F.first("begins").alias("begins"), F.first("rest").alias("rest"))
    order = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    keys = keys.withColumn("begins", F.col("begins") + F.coalesce(F.sum("key_size").over(order), F.lit(0)))
    keys = keys.where("begins < rest and rest <= begins + key_size").select(
        F.col("source").alias("_cut"), F.col("key").alias("cut_key"), F.expr("(rest - begins) div ties").alias("share"))
    return plan.join(keys, F.col("_cut").eqNullSafe(F.col("source")), "left").select(
        "source", "source_size", "target", "epochs", "cut_key", "share")


def mix_sources(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, source and size of ``docs`` with source_size, target and taken, all in words.

    A null source is a source of its own. Documents without words have nothing to take. The
    document at a source's cut is taken in part, so that the source's words are its target to
    the word; rows that agree in id and size share that part evenly, and words that do not come
    out even are left. An empty table gives an empty result.
    """
    docs = docs.select("doc_id", "source", "size")
    plan = small(cuts(docs, p)).withColumnRenamed("source", "_source")
    rows = docs.withColumn("_key", random_key(F.col("doc_id"), F.col("size"), p.seed))
    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("_source")))
    more = F.when(F.col("_key") < F.col("cut_key"), F.col("size")).when(F.col("_key") == F.col("cut_key"), F.col("share"))
    taken = F.col("size") * F.col("epochs") + F.coalesce(more, F.lit(0))
    return rows.select(*docs.columns, "source_size", "target", taken.alias("taken"))


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    """The mix of all documents, in words."""
    docs = documents(spark, sf_dir).select("doc_id", "source", count_words(F.col("text")).alias("size"))
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


def repeat_to_mix(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """``docs`` with each row as often as the mix takes it, columns as they are.

    No text is shuffled: a row's key and its source's cut say how often it comes. The document
    at the cut comes once more if at least half of it is before the cut. Documents without words
    are not taken.
    """
    size = count_words(F.col("text"))
    plan = small(cuts(docs.select("doc_id", "source", size.alias("size")), p))
    plan = plan.select(F.struct("source", "epochs", "cut_key", "share").alias("_mixing_plan"))
    cut = F.col("_mixing_plan")
    rows = docs.withColumn("_mixing_size", size).where("_mixing_size > 0").join(plan, F.col("source").eqNullSafe(cut["source"]))
    key = random_key(F.col("doc_id"), F.col("_mixing_size"), p.seed)
    more = (key < cut["cut_key"]) | ((key == cut["cut_key"]) & (2 * cut["share"] >= F.col("_mixing_size")))
    times = (cut["epochs"] + F.coalesce(more, F.lit(False)).cast("int")).cast("int")
    return rows.withColumn("_mixing_times", times).where("_mixing_times > 0").withColumn(
        "_mixing_time", F.explode(F.sequence(F.lit(1), F.col("_mixing_times")))).select(*docs.columns)
