"""MinHash near-duplicate detection with b-bit signatures.

1. One pass over the texts makes, for each, the set of its k-word shingles, a digest of the set,
   the minima of ``bands * rows`` hash functions, one key per band, and the low ``b`` bits of
   all minima, packed. Texts with the same set fall together by the digest and are one node.
2. Nodes that share a band key are candidates. In every band bucket each node is compared with
   the bucket's smallest node only; components of what was confirmed so far are then taken, and
   nodes of one bucket that are still in different components are compared with each other. A
   bucket full of near copies thus costs one comparison per member, and no link between
   different components is left out.
3. A candidate's similarity is estimated from the equal b-bit values, less the 2^-b that agree
   by chance; pairs far below the threshold (five standard deviations) are put aside, all
   others are confirmed on their full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents, settle
from tidemark.llm.components import components
from tidemark.llm.grams import mix, shingles, word_hashes

_UPPER = {c: c + 32 for c in range(65, 91)}  # A-Z to a-z
CHUNK = 256  # members of a bucket that meet as many others in one group


@dataclass(frozen=True)
class Params:
    """A pair at the threshold of 0.8 misses all bands with probability (1 - 0.8^rows)^bands = 5e-8."""

    k: int = 5
    percent: int = 80  # of the union that the intersection must hold
    bands: int = 32
    rows: int = 4
    seed: int = 11

    @property
    def hashes(self) -> int:
        return self.bands * self.rows

    @property
    def least(self) -> int:
        """Equal 4-bit values that a candidate must show: five deviations below the threshold."""
        j = self.percent / 100
        p = j + (1 - j) / 16
        return max(0, int(self.hashes * p - 5 * (self.hashes * p * (1 - p)) ** 0.5))


def shingle_sets(texts, k: int) -> list[np.ndarray]:
    lower = [t.translate(_UPPER) if isinstance(t, str) else "" for t in texts]
    return [shingles(words, k) for words in word_hashes(lower)]


def minima(elements: np.ndarray, factors: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over a set, a few elements at a time."""
    best = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(elements), 256):
        values = elements[at : at + 256, None] * factors
        values += terms
        np.minimum(best, values.min(axis=0), out=best)
    return best


def pack(low: np.ndarray) -> bytes:
    """4-bit values, sixteen to a 64-bit number."""
    return (low[0::2] | (low[1::2] << 4)).astype(np.uint8).tobytes()


def _signatures(p: Params):
    rng = np.random.default_rng(p.seed)
    factors = rng.integers(1, 1 << 63, p.hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    terms = rng.integers(0, 1 << 63, p.hashes, dtype=np.uint64)
    weights = rng.integers(1, 1 << 63, (p.bands, p.rows), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids, keys, out = part.column(0), part.column(1), {"n": [], "node": [], "bands": [], "sig": []}
                for elements in shingle_sets(part.column(2).to_pylist(), p.k):
                    best = minima(elements, factors, terms)
                    spread = mix(best)
                    keys_of = mix((spread.reshape(p.bands, p.rows) * weights).sum(axis=1) + np.arange(p.bands, dtype=np.uint64))
                    out["n"].append(len(elements))
                    out["node"].append(hashlib.blake2b(elements.tobytes(), digest_size=16).digest() if len(elements) else None)
                    out["bands"].append(keys_of.astype(np.int64) if len(elements) else np.zeros(0, np.int64))
                    out["sig"].append(np.frombuffer(pack((spread & np.uint64(15)).astype(np.uint8)), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [ids, keys, pa.array(out["n"], pa.int64()), pa.array(out["node"], pa.binary()),
                     pa.array(out["bands"], pa.list_(pa.int64())), pa.array(out["sig"], pa.list_(pa.int64()))],
                    names=["doc_id", "text_key", "n_shingles", "node", "bands", "sig"])

    return run


def signatures(docs: DataFrame, p: Params) -> DataFrame:
    """One row per document, written once: set size, node (null for an empty set), band keys, signature."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    made = rows.mapInArrow(
        _signatures(p),
        "doc_id long, text_key long, n_shingles long, node binary, bands array<long>, sig array<long>")
    return settle(made, "signatures")


def equal_values(a: Column, b: Column) -> Column:
    """How many of the packed 4-bit values of two signatures agree."""
    def differing(x: Column, y: Column) -> Column:
        x = x.bitwiseXOR(y)
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        return F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))

    apart = F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda s, x: s + x)
    return F.size(a) * 16 - apart


def estimate(equal: Column, hashes: int) -> Column:
    """Similarity from equal 4-bit values, corrected for those that agree by chance."""
    return (equal / hashes - F.lit(1 / 16)) / F.lit(15 / 16)


def _sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """The full shingle sets of the ``wanted`` (node, doc_id, text_key) as sorted 64-bit hashes."""
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_key"), "text")
    found = rows.join(
        wanted, (F.col("_key") == F.col("text_key")) & F.col("_id").eqNullSafe(F.col("doc_id"))
    ).select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                made = [s.tobytes() for s in shingle_sets(part.column(1).to_pylist(), k)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(made, pa.binary())], names=["node", "elements"])

    return found.mapInArrow(run, "node binary, elements binary").dropDuplicates(["node"])


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether the common elements of two sorted sets are so many percent of all."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def _confirm(p: Params):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("a_elements"), batch.column("b_elements")
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                a, b = (np.frombuffer(c[i].as_buffer(), np.uint64) for c in (left, right))
                keep[i] = similar(a, b, p.percent)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(pa.array(keep)) for c in ("a", "b")], names=["a", "b"])

    return run


def _confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, p: Params) -> DataFrame:
    """The pairs (a, b) whose full sets are as similar as asked, written once."""
    likely = pairs
    for name in ("a", "b"):
        likely = likely.join(nodes.select(F.col("node").alias(name), F.col("n").alias(f"{name}_n"), F.col("sig").alias(f"{name}_sig")), name)
    sizes = F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * p.percent
    likely = settle(likely.where(sizes & (equal_values(F.col("a_sig"), F.col("b_sig")) >= p.least)).select("a", "b"), "likely")
    wanted = likely.select(F.col("a").alias("node")).unionByName(likely.select(F.col("b").alias("node"))).distinct()
    sets = settle(_sets(docs, nodes.join(wanted, "node").select("node", "doc_id", "text_key"), p.k), "sets")
    both = likely
    for name in ("a", "b"):
        both = both.join(sets.select(F.col("node").alias(name), F.col("elements").alias(f"{name}_elements")), name)
    return settle(both.mapInArrow(_confirm(p), "a binary, b binary"), "confirmed")


def _chunked(members: DataFrame) -> DataFrame:
    """``members`` (key, node, root) dealt to bounded groups (key, i, j), written once.

    In each bucket with more than one component, the members outside its largest one (``few``)
    are to meet all members; both sides are dealt to chunks, and a group is a pair of chunks. A
    bucket of any size is thus spread over many tasks. Only names are written here; signatures
    and sets are joined to them afterwards.
    """
    counts = members.groupBy("key", "root").agg(F.count("*").alias("members"))
    mixed = counts.groupBy("key").agg(
        F.count("*").alias("roots"), F.sum("members").alias("all"), F.max(F.struct("members", "root")).alias("main"),
    ).where("roots > 1").select(
        "key", F.col("main.root").alias("main"), F.ceil(F.col("all") / CHUNK).cast("int").alias("all_chunks"),
        F.ceil((F.col("all") - F.col("main.members")) / CHUNK).cast("int").alias("few_chunks"))
    rows = members.join(settle(mixed, "mixed"), "key")
    chunk = F.pmod(F.xxhash64("node"), F.lit(1 << 30)).cast("int")
    few = rows.where(F.col("root") != F.col("main")).select(
        "key", (chunk % F.col("few_chunks")).alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("all_chunks") - 1)).alias("j"), F.lit(True).alias("few"), "node", "root")
    every = rows.select(
        "key", F.explode(F.sequence(F.lit(0), F.col("few_chunks") - 1)).alias("i"),
        (chunk % F.col("all_chunks")).alias("j"), F.lit(False).alias("few"), "node", "root")
    return settle(few.unionByName(every), "groups")


def _likely(group, p: Params) -> Iterator[tuple[int, np.ndarray]]:
    """For each row that is one of the ``few``: the others of the group that may be linked to it.

    Those are of another component, near in size and signature, and share no earlier band: a
    pair that meets in several buckets is looked at in one.
    """
    few, rest = np.flatnonzero(group.few), np.flatnonzero(~group.few)
    if not len(few) or not len(rest):
        return
    key, n, root = group.key.iloc[0], group.n.to_numpy(), group.root.to_numpy()
    sig = np.stack([np.asarray(x, np.int64) for x in group.sig]).view(np.uint8)
    bands = np.stack([np.asarray(x, np.int64) for x in group.bands])
    for k in few:
        x = sig[rest] ^ sig[k]
        equal = ((x & 15) == 0).sum(axis=1) + ((x >> 4) == 0).sum(axis=1)
        fits = (100 * np.minimum(n[rest], n[k]) >= p.percent * np.maximum(n[rest], n[k])) & (root[rest] != root[k])
        at = rest[fits & (equal >= p.least)]
        if len(at):
            yield int(k), at[bands[k][(bands[at] == bands[k]).argmax(axis=1)] == key]


def _apart(buckets: DataFrame, labels: DataFrame, nodes: DataFrame, docs: DataFrame, p: Params) -> DataFrame | None:
    """Links (a, b) between nodes that share a bucket and are in different components so far.

    Signatures say which members of a bucket may have such a link; those meet again with their
    full sets. What is written is a link that joins two parts of a group, never all pairs.
    """
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = settle(buckets.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node")), "placed")
    signed = nodes.select("node", "n", "sig", "bands")

    def grouped(rows: DataFrame):
        # the work of a group is not told by its bytes, so the groups are dealt to all tasks there are
        return rows.repartition(tasks, "key", "i", "j").groupBy("key", "i", "j")

    def suspects(group):
        marked = np.zeros(len(group), bool)
        for k, at in _likely(group, p):
            marked[at] = True
            marked[k] |= len(at) > 0
        return group.loc[marked, ["key", "node"]]

    found = grouped(_chunked(placed).join(signed, "node")).applyInPandas(suspects, "key long, node binary")
    marked = settle(found.distinct(), "suspects")
    if marked.isEmpty():
        return None
    wanted = nodes.join(marked.select("node").distinct(), "node").select("node", "doc_id", "text_key")
    sets = settle(_sets(docs, wanted, p.k), "sets")

    def links(group):
        parent, a, b = {}, [], []

        def top(x):
            while parent.setdefault(x, x) != x:
                x = parent[x]
            return x

        sets, names, roots = [np.frombuffer(e, np.uint64) for e in group.elements], group.node.to_numpy(), group.root.to_numpy()
        for k, at in _likely(group, p):
            for m in at:
                one, two = top(roots[k]), top(roots[m])
                if one != two and similar(sets[k], sets[m], p.percent):
                    parent[one] = two
                    a.append(names[k])
                    b.append(names[m])
        return type(group)({"a": a, "b": b})

    again = _chunked(placed.join(marked, ["key", "node"]))
    return settle(grouped(again.join(signed, "node").join(sets, "node")).applyInPandas(links, "a binary, b binary"), "links")


def _clustered(docs: DataFrame, p: Params) -> DataFrame:
    """doc_id, text_key, n_shingles, root and component_id of every row; ``root`` names its component, null without words."""
    rows = signatures(docs, p)
    nodes = settle(
        rows.where(F.col("node").isNotNull()).groupBy("node").agg(
            F.min("doc_id").alias("least_id"),
            F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "text_key")).alias("one"),
            F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("sig").alias("sig"),
        ).select("node", "least_id", "one.doc_id", "one.text_key", "n", "bands", "sig"), "nodes")
    keyed = nodes.select("node", F.explode("bands").alias("key"))
    hubs = keyed.groupBy("key").agg(F.count("*").alias("members"), F.min("node").alias("hub")).where("members > 1")
    hubs = settle(hubs.select("key", "hub"), "hubs")
    buckets = settle(keyed.join(hubs, "key"), "buckets")
    stars = buckets.where(F.col("node") != F.col("hub")).select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    links = _confirmed(stars, nodes, docs, p)
    found = settle(components(links), "components")
    more = _apart(buckets.select("key", "node"), found, nodes, docs, p)
    if more is not None:
        found = settle(components(links.unionByName(more)), "components")
    named = found.join(nodes.select("node", "least_id"), "node")
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    linked = found.join(least, "root").select("node", "root", "component_id")
    placed = nodes.select("node", "least_id").join(linked, "node", "left").select(
        "node", F.coalesce("root", "node").alias("root"), F.coalesce("component_id", "least_id").alias("component_id"))
    columns = ["doc_id", "text_key", "n_shingles", "root", "component_id"]
    alone = rows.where(F.col("node").isNull()).withColumns({"root": F.lit(None).cast("binary"), "component_id": F.col("doc_id")})
    return rows.where(F.col("node").isNotNull()).join(placed, "node").select(*columns).unionByName(alone.select(*columns))


def near_duplicates(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs`` (doc_id, text).

    A text without words is linked with nothing. ``component_id`` is the smallest doc_id of
    those reachable; a row whose doc_id is null takes part by its text, and where no row of its
    component has an id, component_id is null and the row is kept. Repeated rows are all kept
    or all not. An empty table gives an empty result.
    """
    return _clustered(docs, p).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op3_neardup(spark, sf_dir: str) -> DataFrame:
    """Near duplicates of all documents by 2-word shingles."""
    return near_duplicates(documents(spark, sf_dir).select("doc_id", "text"), Params(k=2))


def keep_one(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, columns as they are.

    That is the row of the smallest id, those without an id last, and of an id's texts the one of the
    smallest hash; of rows that repeat its id and text, one. Rows without words stay.
    """
    found = settle(_clustered(docs.select("doc_id", "text"), p).where(F.col("root").isNotNull()), "clustered")
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", "text_key")).alias("one"))
    first = settle(first.select(F.col("one.doc_id").alias("_near_id"), F.col("one.text_key").alias("_near_key")), "firsts")
    here, words = F.col("doc_id").cast("long"), F.col("_near_words")
    rows = docs.withColumn("_near_words", F.col("text").rlike(r"[^ \t-\r]"))
    kept = rows.where(words).join(first, (F.xxhash64("text") == F.col("_near_key")) & here.eqNullSafe(F.col("_near_id")))
    repeated = found.groupBy("doc_id", "text_key").agg(F.count("*").alias("n")).where("n > 1").select(
        F.col("doc_id").alias("_again_id"), F.col("text_key").alias("_again_key"))
    repeated = settle(repeated, "repeated")
    out = kept
    if not repeated.isEmpty():
        same = (F.col("_near_key") == F.col("_again_key")) & F.col("_near_id").eqNullSafe(F.col("_again_id"))
        # rows that agree in id and text: one of them, whatever its other columns say
        many = kept.join(repeated, same, "left_semi").groupBy("_near_id", "_near_key").agg(F.first(F.struct(*[f"`{c}`" for c in docs.columns])).alias("_one"))
        out = kept.join(repeated, same, "left_anti").select(*docs.columns).unionByName(many.select("_one.*"))
    return out.select(*docs.columns).unionByName(rows.where(~F.coalesce(words, F.lit(False))).select(*docs.columns))
