"""URL filters: listed rules first, then association rules mined from labelled URLs.

A URL's tokens are the words of its host, path and rest, each with where it stands. FP-growth over
the labelled URLs finds token combinations that are frequent together with the mark of a bad page;
where URLs have many frequent tokens, the combinations are grown level by level instead. Those of
enough support and confidence, less any that hold a smaller one, become block rules. Each
rule is posted under its rarest token in an inverted index of hashed tokens. Each rule holds for a
share of the labelled URLs, so the index stays small and travels as a literal: a URL looks up its
own tokens and checks the few rules found there, without a shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import settle, small

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BAD = "=bad"  # the item of a bad page; no token looks like it

#: (rule, verdict): a rule is a host, which its subdomains share, and the beginning of a path.
LISTED = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))


@dataclass(frozen=True)
class Params:
    """Where no URL has more than ``most_items`` frequent tokens, FP-growth takes them all: a URL then has at
    most 2^most_items combinations. Where one has more, combinations of all its tokens are grown level by
    level, only those that a smallest rule can come from. No token is left out either way."""

    least_share: float = 0.002  # of the labelled URLs that a rule must hold for and be right about
    least_urls: int = 3  # and at least so many
    least_confidence: float = 0.5
    most_items: int = 10  # frequent tokens of a URL up to which FP-growth mines
    buckets: int = 4096  # of the inverted index


def host_of(url: Column) -> Column:
    """What is between the first ``://`` and the path, A-Z lower-cased; empty without ``://`` or url."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column) -> Column:
    """Distinct words of host (``h:``), path (``p:``) and rest (``q:``); a run of digits reads 0. None without ``://``."""
    def part(text: Column, mark: str) -> Column:
        plain = F.regexp_replace(F.translate(text, UPPER, LOWER), "[0-9]+", "0")
        return F.transform(F.filter(F.split(plain, SEPARATORS), lambda w: w != ""), lambda w: F.concat(F.lit(mark), w))

    rest = F.coalesce(F.regexp_extract(url, r"(?s)://[^?#]*(.*)", 1), F.lit(""))
    return F.array_distinct(F.concat(part(host_of(url), "h:"), part(path_of(url), "p:"), part(rest, "q:")))


def listed(host: Column, path: Column, rules=LISTED) -> Column:
    """The longest rule that fits, as a struct of rule and verdict; null where none does."""
    found = []
    for rule, verdict in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(slash + rest))
        found.append(F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*found) if found else F.lit(None).cast("struct<rule:string,verdict:string>")


def grown(sets: DataFrame, least: int, p: Params) -> DataFrame:
    """(tokens, right, confidence) of the smallest block rules of rows (items, bad), of any number of items.

    Alike URLs are one row with a count. A combination grows only while it is right ``least`` times, is no rule
    itself and is held by fewer URLs than every part of it: one held by the same URLs as a part is as sure
    as that part, so nothing that holds it is a smallest rule. Copies of a long URL therefore end at once.
    """
    urls = settle(sets.groupBy("items").agg(F.count("*").alias("n"), F.count_if("bad").alias("right")).where(
        F.size("items") > 0).withColumn("url", F.monotonically_increasing_id()), "url-sets")
    has = urls.select("url", "n", "right", F.explode("items").alias("token")).select("url", "n", "right", F.array("token").alias("tokens"))
    out, live = [], None
    while True:
        counts = has.groupBy("tokens").agg(F.sum("n").alias("n"), F.sum("right").alias("right")).where(F.col("right") >= least)
        if live is not None:
            part = counts.select("tokens", "n", F.posexplode("tokens").alias("at", "token")).select(
                "tokens", F.col("n").alias("_n"), F.expr("filter(tokens, (t, i) -> i <> at)").alias("part"))
            parts = part.join(live.select(F.col("tokens").alias("part"), "n"), "part").groupBy("tokens").agg(
                F.count("*").alias("parts"), F.min(F.col("n") - F.col("_n")).alias("fewer"))
            counts = counts.join(parts.where("parts = size(tokens) AND fewer > 0").select("tokens"), "tokens", "left_semi")
        counts = settle(counts.withColumn("confidence", F.col("right") / F.col("n")), "url-combinations")
        out.append(counts.where(F.col("confidence") >= p.least_confidence).select("tokens", "right", "confidence"))
        live = counts.where(F.col("confidence") < p.least_confidence)
        if live.isEmpty():
            break
        has = has.join(live.select("tokens"), "tokens", "left_semi").select(
            "url", "n", "right", F.expr("slice(tokens, 1, size(tokens) - 1)").alias("begin"), F.element_at("tokens", -1).alias("last"))
        more = has.select(F.col("url").alias("_url"), F.col("begin").alias("_begin"), F.col("last").alias("_last"))
        pairs = has.join(more, (F.col("url") == F.col("_url")) & (F.col("begin") == F.col("_begin")) & (F.col("last") < F.col("_last")))
        has = settle(pairs.select("url", "n", "right", F.concat("begin", F.array("last", "_last")).alias("tokens")), "url-held")
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found


def mine(labelled: DataFrame, p: Params = Params()) -> DataFrame:
    """(tokens, post, support, confidence) of the block rules from rows (url, bad).

    Rows without a url are not learned from. ``tokens`` are in order; ``post`` is the rarest.
    """
    rows = labelled.where("url is not null").select(
        F.monotonically_increasing_id().alias("row"), tokens_of(F.col("url")).alias("tokens"), F.coalesce("bad", F.lit(False)).alias("bad"))
    rows = settle(rows, "labelled-urls")
    n = rows.count()
    least = max(math.ceil(p.least_share * n), p.least_urls)
    each = rows.select("row", F.explode("tokens").alias("token"))
    frequent = small(each.groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") >= least))
    kept = each.join(frequent, "token").groupBy("row").agg(F.array_sort(F.collect_list("token")).alias("items"))
    none = F.array().cast("array<string>")
    sets = settle(rows.join(kept, "row", "left").select(F.coalesce("items", none).alias("items"), "bad"), "url-items")
    if n < least:
        found = sets.select(F.col("items").alias("tokens"), F.lit(0.0).alias("confidence"), F.lit(0.0).alias("support")).limit(0)
    elif sets.agg(F.max(F.size("items"))).first()[0] > p.most_items:
        found = grown(sets, least, p).withColumn("support", F.col("right") / F.lit(float(n))).select("tokens", "confidence", "support")
    else:
        parts = int(labelled.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        marked = sets.select(F.concat("items", F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(none)).alias("items"))
        model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n, minConfidence=p.least_confidence, numPartitions=parts).fit(marked)
        found = model.associationRules.where(F.array_contains("consequent", BAD)).select(
            F.array_sort("antecedent").alias("tokens"), "confidence", "support")
    rules = settle(found, "url-rules")
    # a rule that holds another adds nothing: all its URLs match the smaller one. None of FP-growth's has more
    # than most_items tokens; those grown hold no other, and a part that is a rule is found by its size
    smaller = F.expr("transform(sequence(1, shiftleft(1L, size(tokens)) - 2), m -> filter(tokens, (t, i) -> (shiftright(m, i) & 1) = 1))")
    held = rules.where((F.size("tokens") > 1) & (F.size("tokens") <= p.most_items)).select(F.col("tokens").alias("whole"), F.explode(smaller).alias("tokens"))
    held = held.join(rules.select("tokens"), "tokens", "left_semi").select(F.col("whole").alias("tokens")).distinct()
    rules = rules.join(held, "tokens", "left_anti")
    post = rules.select("tokens", "confidence", "support", F.explode("tokens").alias("token")).join(frequent, "token")
    return post.groupBy("tokens", "confidence", "support").agg(F.min(F.struct("n", "token"))["token"].alias("post"))


def _bucket(token: Column, p: Params) -> Column:
    return (F.crc32(token.cast("binary")) % p.buckets).cast("int")


@dataclass(frozen=True)
class Index:
    """``rules`` in the order of their buckets, each as its rank and tokens; ``bounds``: where each bucket's begin."""

    rules: tuple[str, ...]
    bounds: tuple[int, ...]


def inverted(rules: DataFrame, p: Params = Params()) -> Index:
    """The rules by bucket of the token they are posted under; the surest rule has the smallest rank."""
    order = [F.desc("confidence"), F.desc("support"), F.asc("text")]
    rows = rules.select(_bucket(F.col("post"), p).alias("bucket"), F.array_join("tokens", " ").alias("text"), "confidence", "support")
    found = rows.orderBy(*order).collect()  # smallest rules only, each right for least_share of the labelled URLs
    ranked = sorted((r.bucket, f"{k:09d} {r.text}") for k, r in enumerate(found))
    counts = [0] * (p.buckets + 1)
    for at, _ in ranked:
        counts[at + 1] += 1
    for k in range(p.buckets):
        counts[k + 1] += counts[k]
    return Index(tuple(text for _, text in ranked), tuple(counts))


def matched(tokens: Column, index: Index, p: Params = Params()) -> Column:
    """The tokens of the surest rule whose tokens are all there; null if there is none."""
    if not index.rules:
        return F.lit(None).cast("string")
    rules = F.split(F.lit("\n".join(index.rules)), "\n")  # both folded to constants
    bounds = F.split(F.lit(",".join(map(str, index.bounds))), ",").cast("array<int>")

    def posted(token: Column) -> Column:
        at = F.get(bounds, _bucket(token, p))
        return F.slice(rules, at + 1, F.get(bounds, _bucket(token, p) + 1) - at)

    def holds(rule: Column) -> Column:
        return F.forall(F.split(F.substr(rule, F.lit(11)), " "), lambda t: F.array_contains(tokens, t))

    return F.substr(F.array_min(F.filter(F.flatten(F.transform(tokens, posted)), holds)), F.lit(11))


def judge(urls: DataFrame, index: Index, rules=LISTED, p: Params = Params()) -> DataFrame:
    """``urls`` with host, path, rule, verdict and pattern, the mined rule that blocks.

    Columns of these names are replaced. A null url, or one without ``://``, has an empty host and
    path, fits no rule and is allowed. Repeated rows are judged alike; an empty table stays empty.
    """
    rows = urls.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rows = rows.withColumns({"_listed": listed(F.col("host"), F.col("path"), rules), "_tokens": tokens_of(F.col("url"))})
    rows = rows.withColumn("pattern", F.when(F.col("_listed").isNull(), matched(F.col("_tokens"), index, p)))
    mined = F.when(F.col("pattern").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return rows.withColumns({"rule": F.col("_listed.rule"), "verdict": F.coalesce(F.col("_listed.verdict"), mined)}).drop("_listed", "_tokens")


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, bad) of the pages whose document is labelled: bad if of quality 0 or toxic.

    A page shows the document that the second part of its path names by number. A document that
    is labelled several times is bad if one label says so.
    """
    number = F.regexp_extract(path_of(F.col("url")), r"^/[^/]*/([0-9]{1,18})", 1)
    shown = pages.where("url is not null").select("url", number.try_cast("bigint").alias("_document"))
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("_document")).agg(F.max(bad).alias("bad"))
    return shown.join(known, "_document").select("url", "bad")


def op11_urls(spark, sf_dir: str) -> DataFrame:
    """Every page's url judged by the listed rules, then by what the labels teach."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    index = inverted(mine(labelled_urls(pages, spark.read.parquet(f"{sf_dir}/labels.parquet"))))
    return judge(pages, index).select("page_id", "host", "path", "rule", "verdict", "pattern")
