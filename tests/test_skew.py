"""Heavy keys change the plan, never the result."""

import math

from conftest import SMALL
from pyspark.sql import functions as F

from tidemark.operators.attach import attach, group_rows
from tidemark.operators.joins import Heavy, heavy_keys, key_counts, lookup_join, salted_join
from tidemark.operators.prepare import attach_items, localize, prepare
from tidemark.plans.features import long_features
from tidemark.plans.spec import SPEC_1
from tidemark.plans.splits import SET_2, survey
from tidemark.sources.adapters import watch_events, watch_items

SOME = SPEC_1.pick((3, 30), lambda f: True)


def rounded(df):
    cols = [
        F.round(F.col(f"`{c}`"), 6).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes
    ]
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda r: r[:3])


def skewed(spark):
    """The given events with one user and one video taking over a third of the rows."""
    events = watch_events(spark, SMALL)
    copies = events.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(1)))).where("k = 1 OR did <> 3")
    return events.unionByName(copies.drop("k").withColumns({"did": F.lit(3), "vid": F.lit(29)}))


def assert_same(want, got):
    assert len(want) == len(got) and len(want) > 50
    for a, b in zip(want, got, strict=True):
        for x, y in zip(a, b, strict=True):
            close = isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-6, abs_tol=1e-5)
            assert close or x == y, (a[:3], x, y)


def build(spark, events, task_rows, broadcast_bytes, keep=True):
    items = watch_items(spark, SMALL)
    layout = survey(events, SET_2, task_rows=task_rows)
    joined = prepare(events, items, items.count(), layout.items)
    return layout, long_features(joined, layout, SOME, broadcast_bytes=broadcast_bytes, keep_cells=keep)


def test_heavy_users_and_items_give_the_same_features(spark):
    events = skewed(spark)
    plain_layout, plain = build(spark, events, 10**6, 2**26)
    heavy_layout, heavy = build(spark, events, 100, 0)
    assert not plain_layout.users.any and not plain_layout.items.any
    assert 3 in heavy_layout.users.keys and 29 in heavy_layout.items.keys
    assert heavy_layout.items.salts > 2
    assert_same(rounded(plain), rounded(heavy))


def test_partition_count_does_not_matter(spark):
    events = watch_events(spark, SMALL)
    want = rounded(build(spark, events, 10**6, 2**26)[1])
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        got = rounded(build(spark, events, 10**6, 2**26, keep=False)[1])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert_same(want, got)


def test_salted_item_join_equals_plain(spark):
    events = localize(skewed(spark))
    items = watch_items(spark, SMALL).drop("online_time")
    want = events.join(items, "vid", "left")
    heavy = Heavy((29, 7), 700, 50)
    got = salted_join(events, items, ["vid"], heavy, ["did", "timestamp"]).select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert got.count() == events.count()


def test_missing_keys_are_spread_and_kept(spark):
    left = spark.createDataFrame([(None, i) for i in range(50)] + [(1, 0)], "vid long, did long")
    right = spark.createDataFrame([(1, "x")], "vid long, cid string")
    got = salted_join(left, right, ["vid"], Heavy((), 50, 10, True), ["did"])
    assert got.count() == 51 and got.where("cid = 'x'").count() == 1


def test_lookup_is_broadcast_only_under_the_limit(spark):
    events, items = watch_events(spark, SMALL), watch_items(spark, SMALL)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    small = attach_items(events, items, 100)
    assert "strategy=broadcast" in plan(small)
    big = attach_items(events, items, 10**9)
    assert "strategy=broadcast" not in plan(big)
    same = lookup_join(events, items, ["vid"], right_rows=10**9, row_bytes=8, heavy=Heavy(), spread_on=["did"])
    assert same.count() == events.count()


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_heavy_keys_are_those_over_the_floor(spark):
    rows = [(1,)] * 30 + [(2,)] * 10 + [(3,)] * 11 + [(None,)] * 12
    heavy = heavy_keys(key_counts(spark.createDataFrame(rows, "k long"), "k"), 10)
    assert set(heavy.keys) == {1, 3} and heavy.nulls and heavy.most_rows == 30 and heavy.salts == 3
    assert not heavy_keys(key_counts(spark.createDataFrame(rows, "k long"), "k"), 100).any


def test_unknown_size_is_never_broadcast(spark):
    events, items = watch_events(spark, SMALL), watch_items(spark, SMALL)
    layout = survey(events, SET_2, skew=False)
    assert layout.items_seen is None
    long = long_features(prepare(events, items, 10**9), layout, SOME, keep_cells=False, broadcast_bytes=1)
    assert "strategy=broadcast" not in plan_of(long)
    known = long_features(prepare(events, items, 10), survey(events, SET_2), SOME, keep_cells=False, broadcast_bytes=1)
    assert "approx_top_k" not in plan_of(known)


def test_attach_spreads_heavy_and_missing_keys(spark):
    events = skewed(spark).withColumn("vid", F.when(F.col("timestamp") % 5 != 0, F.col("vid")))
    groups = group_rows(events.where("vid IS NOT NULL"), ["vid"], "g_vid")
    want = events.join(groups, "vid", "left")
    got = attach(events, ["vid"], groups, heavy=heavy_keys(key_counts(events, "vid"), 100))
    assert "_salt" in plan_of(got)
    assert got.select(*want.columns).exceptAll(want).count() == 0 and got.count() == events.count()
