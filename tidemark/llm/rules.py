"""Quality rules: plain counts, and a hashed n-gram log-likelihood ratio, in DataFrame operations only.

Words and word pairs are hashed to a fixed number of buckets. Two multinomials over the buckets,
one of a trusted target and one of the whole corpus, give each bucket a log ratio, rounded to
millionths so that sums are exact whole numbers in any order. A document's verdict is its mean
ratio against a fixed threshold: every document, no drawing of lots. The buckets' numbers are a
table of bounded size that travels as a literal, so scoring shuffles nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BROADCAST_IDS, documents, settle, small, words

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8  # words


@dataclass(frozen=True)
class Params:
    """The target is every document labelled good."""

    buckets: int = 65_536
    least_ratio: int = -100_000  # millionths per n-gram
    least_words: int = 20
    most_repeated: int = 30  # percent of words in repeated windows


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once for each row."""
    return F.transform(F.array(value), use).getItem(0)


def pairs(ws: Column) -> Column:
    """Neighbouring words, joined by one blank; none of fewer than two words."""
    n = F.greatest(F.size(ws) - 1, F.lit(0))
    return F.zip_with(F.slice(ws, F.lit(1), n), F.slice(ws, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b))


def bucket(gram: Column, buckets: int) -> Column:
    return F.crc32(gram.cast("binary")) % buckets


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def window_hashes(ws: Column) -> Column:
    """A 64-bit hash of the eight words from each word on, made of hashes of two, four and eight."""
    def doubled(hashes: Column, by: int) -> Column:
        return let(hashes, lambda h: let(F.greatest(F.size(h) - by, F.lit(0)), lambda n: F.zip_with(
            F.slice(h, F.lit(1), n), F.slice(h, F.lit(by + 1), n), lambda a, b: F.xxhash64(a, b))))

    return doubled(doubled(doubled(F.transform(ws, lambda w: F.xxhash64(w)), 1), 2), 4)


def repeated_words(ws: Column, hashes: Column) -> Column:
    """Words inside windows that occur twice or more. Equal hashes are confirmed on the words."""
    def same(a: Column, b: Column) -> Column:
        return (a["h"] == b["h"]) & (F.slice(ws, a["i"] + 1, F.lit(WINDOW)) == F.slice(ws, b["i"] + 1, F.lit(WINDOW)))

    ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(s: Column) -> Column:
        again = F.filter(s, lambda x, k: ((k > 0) & F.coalesce(same(x, F.get(s, k - 1)), F.lit(False)))
                         | F.coalesce(same(x, F.get(s, k + 1)), F.lit(False)))
        return F.array_sort(F.transform(again, lambda x: x["i"]))

    covered = F.aggregate(
        let(ordered, places), F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")), lambda a: a["n"])
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(covered)


def ratios(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> list[int]:
    """Each bucket's log ratio of the target's share over the corpus's, in millionths, smoothed by one.

    With no target, or an empty corpus, no bucket tells anything and all are 0.
    """
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    there = docs.where("doc_id is not null").select("doc_id").distinct()
    target = small(good.join(there, "doc_id", "left_semi").withColumn("_target", F.lit(1)), BROADCAST_IDS)
    named = docs.where("doc_id is not null").select("doc_id", "text").join(target, "doc_id", "left")
    rows = named.select("_target", "text").unionByName(docs.where("doc_id is null").select(F.lit(None).cast("int").alias("_target"), "text"))
    rows = rows.select("_target", words(F.col("text")).alias("_ws"))
    grams = rows.select("_target", F.explode(F.concat("_ws", pairs(F.col("_ws")))).alias("gram"))
    counts = settle(grams.groupBy(bucket(F.col("gram"), p.buckets).cast("int").alias("bucket")).agg(
        F.count("*").alias("raw"), F.count("_target").alias("target")), "buckets")
    raw, target_sum = counts.agg(F.coalesce(F.sum("raw"), F.lit(0)), F.coalesce(F.sum("target"), F.lit(0))).first()
    if not target_sum:
        return [0] * p.buckets
    ratio = F.log(((F.col("target") + 1.0) * (raw + p.buckets)) / ((target_sum + p.buckets) * (F.col("raw") + 1.0)))
    unseen = docs.sparkSession.range(1).select(F.lit(-1).alias("bucket"), F.lit(0).alias("raw"), F.lit(0).alias("target"))
    found = counts.unionByName(unseen).select("bucket", F.round(ratio * 1e6).cast("long").alias("ratio")).collect()
    of = {r.bucket: r.ratio for r in found}  # buckets + 1 numbers at most
    return [of.get(k, of[-1]) for k in range(p.buckets)]


def judge(docs: DataFrame, table: list[int], p: Params = Params(), text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept and ratio.

    Columns of these names are replaced. A null text counts as an empty one, fails the base rules
    and has no ratio. Repeated rows are judged alike; an empty table stays empty.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    literal = F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>")  # folded to one constant

    def summed(grams: Column) -> Column:
        return F.aggregate(grams, F.lit(0).cast("long"), lambda s, g: s + F.get(literal, bucket(g, p.buckets).cast("int")))

    rows = docs.withColumns({
        "_ws": words(F.col(text)),
        "n_symbols": F.regexp_count(t, F.lit(f"[{SYMBOLS}]")).cast("long"),
        "n_dup_lines": repeated_lines(t).cast("long"),
    })
    rows = rows.withColumns({
        "n_words": F.size("_ws").cast("long"),
        "word_chars": F.length(F.array_join("_ws", "")).cast("long"),
        "_hashes": window_hashes(F.col("_ws")),
        "_sum": summed(F.col("_ws")) + summed(pairs(F.col("_ws"))),
    })
    rows = rows.withColumn("n_repeat_words", repeated_words(F.col("_ws"), F.col("_hashes")).cast("long")).drop("_ws", "_hashes")
    failed = (F.col("n_words") < p.least_words) | (100 * F.col("n_repeat_words") > p.most_repeated * F.col("n_words"))
    grams = 2 * F.col("n_words") - 1
    return rows.withColumn("base_failed", failed).withColumns({
        "ratio": F.when(F.col("n_words") > 0, F.round(F.col("_sum") / (grams * 1e6), 9)),
        "kept": ~failed & (F.col("_sum") >= p.least_ratio * grams),
    }).drop("_sum")


def op2_rules(spark, sf_dir: str) -> DataFrame:
    """The rules and the ratio's verdict for every document."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    judged = judge(docs, ratios(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio")
