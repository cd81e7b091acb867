"""Anchors of a table, exact places, even folds, value codes, broken lines, days as folders, the best round."""

import random
from datetime import date, timedelta

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tidemark.functions.clock import day_number
from tidemark.operators.anchors import anchor_activity, anchored_events
from tidemark.operators.attach import attach, group_rows
from tidemark.operators.joins import Heavy, heavy_keys, key_counts, salted_join
from tidemark.operators.prepare import localize
from tidemark.operators.ranges import day_range, instant_range, lookback
from tidemark.operators.ranks import even_folds, placed, value_codes
from tidemark.plans import training
from tidemark.plans.splits import SET_1, history_members, label_members, survey, window_members
from tidemark.session import new_path
from tidemark.sources import tables
from tidemark.sources.adapters import watch_events
from tidemark.sources.schema import BEHAVIORS

START = date(2024, 1, 1)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def meeting_case(spark):
    rng = random.Random(5)
    events = [(rng.choice(["a", "b", "c", "hot", "hot", "hot", None]), rng.choice([1, 2, 3, None]), rng.choice([1.0, 2.5, None]),
               rng.choice([START + timedelta(days=rng.randint(0, 90)), None]), k) for k in range(800)]
    anchors = [(rng.choice(["a", "b", "hot", "none", None]), START + timedelta(days=rng.randint(-5, 95)), rng.choice([1, 3, 16, 40, 200, 0])) for _ in range(60)]
    anchors += anchors[:5] + [("a", None, 5), ("a", START, None)]
    return (events, anchors, spark.createDataFrame(events, "did string, vid long, vts double, date_day date, k long").repartition(3),
            spark.createDataFrame(anchors, "did string, anchor date, days int"))


def inside(event, anchor):
    return None not in (event[0], event[3], *anchor) and event[0] == anchor[0] and 0 <= (anchor[1] - event[3]).days < anchor[2]


@pytest.mark.parametrize("heavy", [Heavy(), Heavy(("hot",), 90, 20)])
@pytest.mark.parametrize("width", [1, 16, 1000])
def test_events_meet_their_anchors(spark, heavy, width):
    events, anchors, left, right = meeting_case(spark)
    got = sorted((r.k, r.did, r.anchor, r.days, r.age) for r in anchored_events(left, right, heavy, width).collect())
    want = sorted((e[4], a[0], a[1], a[2], (a[1] - e[3]).days) for a in set(anchors) for e in events if inside(e, a))
    assert got == want


def test_anchor_activity_is_that_of_a_plain_join(spark):
    events, anchors, left, right = meeting_case(spark)
    got = {(r.did, r.anchor, r.days): (r.active_days, r.watch_nums, r.videos, r.watch_durations) for r in anchor_activity(left, right, Heavy(("hot",), 90, 20)).collect()}
    assert set(got) == set(anchors)
    for a in set(anchors):
        met = [e for e in events if inside(e, a)]
        seconds = [e[2] for e in met if e[2] is not None]
        assert got[a] == (len({e[3] for e in met}), len(met), len({e[1] for e in met}), sum(seconds) if seconds else None)


def test_anchors_need_no_nested_loop(spark):
    *_, left, right = meeting_case(spark)
    plan = plan_of(anchor_activity(left, right))
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("ties", [False, True])
def test_places_are_exact_and_no_task_has_all(spark, ties):
    rows = spark.range(5000).select((F.lit(7) if ties else F.pmod(F.xxhash64("id"), F.lit(900))).alias("v"), "id").repartition(6)
    out = placed(rows, [F.col("v").desc()])
    assert "SinglePartition" not in plan_of(out)
    got = sorted((r.place, r.v) for r in out.collect())
    assert [p for p, _ in got] == list(range(1, 5001)) and [v for _, v in got] == sorted((v for _, v in got), reverse=True)
    assert placed(rows.limit(0), [F.col("v")]).count() == 0


def test_folds_differ_by_one_key(spark):
    rows = spark.range(1003).select(F.pmod("id", F.lit(501)).alias("did"), F.col("id").alias("n")).unionByName(spark.createDataFrame([(None, -1), (None, -2)], "did long, n long"))
    out = even_folds(rows, "did", 5)
    sizes = sorted(r.n for r in out.groupBy("fold").agg(F.count_distinct(F.coalesce("did", F.lit(-9))).alias("n")).collect())
    assert out.count() == 1005 and sum(sizes) == 502 and sizes[-1] - sizes[0] <= 1
    assert out.groupBy("did").agg(F.count_distinct("fold").alias("n")).where("n > 1").count() == 0
    again = even_folds(rows.repartition(9), "did", 5).select("n", "fold")
    assert again.exceptAll(out.select("n", "fold")).count() == 0


def test_codes_follow_frequency(spark):
    rows = [("b",)] * 5 + [("a",)] * 5 + [("c",)] * 9 + [("z",)] + [(None,)] * 30
    got = [(r.value, r.rows, r.code) for r in value_codes(spark.createDataFrame(rows, "v string"), "v").orderBy("code").collect()]
    assert got == [("c", 9, 0), ("a", 5, 1), ("b", 5, 2), ("z", 1, 3)]
    many = spark.range(3000).select(F.concat(F.lit("v"), F.col("id") % 1000).alias("like"), F.col("id").alias("did"))
    coded = training.number_texts(many, many.where("did < 2500"))
    assert coded.select("like").distinct().count() == 1000 and "collect" not in plan_of(coded)


def write_lines(spark, lines):
    path = new_path(spark, "t-lines") + ".csv"
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    return path


def test_broken_lines_are_kept_with_their_text(spark):
    good = ["u1,v1,1.5,100", "u2,,,200", '"u,3",v3,2,300']
    broken = ["u4,v4,1.0", "u5,v5,1.0,5,more", "u6,v6,abc,600", "u7,v7,1.0,12.5x", '"u8"x,v8,"1,800']
    kept, rejects = tables.read_lines(spark, write_lines(spark, ["did,vid,vts,timestamp", *good, *broken]), BEHAVIORS)
    assert sorted(tuple(r) for r in kept.collect()) == [("u,3", "v3", 2.0, 300), ("u1", "v1", 1.5, 100), ("u2", None, None, 200)]
    assert sorted(r.line for r in rejects.collect()) == sorted(broken)


def test_lines_are_matched_by_name(spark):
    lines = ["timestamp,more,did,vts,vid", "100,x,u,1.5,v", "y,x,u,1.5,v"]
    kept, rejects = tables.read_lines(spark, write_lines(spark, lines), BEHAVIORS)
    assert [tuple(r) for r in kept.collect()] == [("u", "v", 1.5, 100)] and [r.line for r in rejects.collect()] == ["y,x,u,1.5,v"]


@pytest.fixture(scope="module")
def by_day(spark):
    events = watch_events(spark, SMALL)
    path = new_path(spark, "t-by-day")
    tables.write_by_day(events, path)
    return events, survey(events, SET_1, skew=False), tables.read_by_day(spark, path)


def test_ranges_labels_and_windows_choose_folders(spark, by_day):
    events, layout, stored = by_day
    local, day = localize(events), F.date_from_unix_date(F.lit(layout.last))
    end = events.agg(F.max("timestamp")).first()[0]
    ways = {
        "day_range": lambda df: day_range(df, day, 6), "lookback": lambda df: lookback(df, day, 7), "instant_range": lambda df: instant_range(df, end, 7),
        "labels": lambda df: label_members(df, layout.only("valid")), "histories": lambda df: history_members(df, layout.only("train_3")),
        "windows": lambda df: window_members(df, layout, (1, 7)).where(day_number(F.col("date_day")) >= layout.last - 6),
    }
    for name, way in ways.items():
        scan = next(line for line in plan_of(way(stored)).splitlines() if "PartitionFilters" in line)
        assert "date_day" in scan.split("PartitionFilters")[1].split("PushedFilters")[0], name
        columns = ["did", "vid", "vts", "timestamp", "date_day"]
        got, want = way(stored).select(*columns), way(local).select(*columns)
        assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0, name


def test_rows_without_a_key_are_dealt_to_all_tasks(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 10 == 0, F.col("id") % 7).alias("vid"), F.col("id").alias("did"))
    counts = rows.where("vid is not null").groupBy("vid").agg(F.count("*").alias("n"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = salted_join(rows, counts, ["vid"], Heavy(), ["did"])
        sizes = [r.n for r in out.where("vid is null").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 18_000 and len(sizes) >= 6 and max(sizes) < 3 * 18_000 / 8
    assert out.count() == 20_000 and out.where("vid is not null and n is null").count() == 0


@pytest.mark.parametrize("literals", [0, 200])
def test_hot_keys_are_split_from_a_list_or_a_table(spark, literals):
    rows = spark.range(12_000).select(F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.col("id") % 500).alias("vid"), F.col("id").alias("did"))
    heavy = heavy_keys(key_counts(rows, "vid"), 500, literals)
    assert (heavy.table is None) == (literals > 0) and heavy.most_rows >= 4000
    got = attach(rows, ["vid"], group_rows(rows, ["vid"], "n"), heavy=heavy)
    plain = {r.vid: r.n for r in rows.groupBy("vid").agg(F.count("*").alias("n")).collect()}
    assert got.count() == 12_000
    assert all(r.n == (plain[r.vid] if r.vid is not None else None) for r in got.select("vid", "n").distinct().collect())
    marked = heavy.marked(rows, "vid", "hot").groupBy("hot").count().collect()
    assert {r["hot"]: r["count"] for r in marked}[True] == plain[1] + (plain[None] if heavy.nulls else 0)


def test_the_best_round_is_kept(spark):
    """Few noisy rows to learn from: the error on other rows falls first and then rises."""
    rng = random.Random(3)
    rows = []
    for k in range(900):
        x, z, w = rng.random() * 8, rng.random(), rng.random()
        rows.append(("valid" if k % 3 else "train", str(k), 3 * int(x) + 9 * z + 7 * w + rng.gauss(0, 4), x, z, w))
    table = spark.createDataFrame(rows, "split string, did string, active_days double, x double, z double, w double")
    vectors = training.vectorize(table, ["x", "z", "w"], ("active_days",)).cache()
    params = training.Params(rounds=60, learning_rate=0.3, max_depth=3, max_bins=64, feature_fraction=1.0, patience=10)
    model, scored = training.fit_holdout(vectors, "active_days", params)
    whole = training.fit_one(vectors.where("split = 'train'"), "active_days", None, params)
    errors = whole.evaluateEachIteration(vectors.where("split = 'valid'"), "squared")
    best = training.best_round(errors, 10)[0]
    assert 1 < best < 50 and model.getNumTrees == best < whole.getNumTrees == 60
    error = scored.select(F.avg((F.col("active_days") - F.col("active_days_preds")) ** 2)).first()[0]
    assert abs(error - errors[best - 1]) < 1e-6 * error and error < errors[-1]
    assert training.cut(model, 1).getNumTrees == 1


@pytest.mark.parametrize("errors, patience, want", [
    ([5, 4, 3], 2, (3, False)), ([5, 3, 4, 4, 1], 2, (2, True)), ([5, 3, 4, 4, 1], 3, (5, False)), ([1, 2, 3], 2, (1, True)), ([2.0], 1, (1, False)), ([3, 3, 3], 2, (1, True))])
def test_best_round(errors, patience, want):
    assert training.best_round(errors, patience) == want


def test_importance_is_that_of_the_node_tables(spark):
    rows = spark.range(400).select(F.lit("s").alias("split"), F.col("id").cast("string").alias("did"), (F.col("id") % 7).cast("double").alias("active_days"),
                                   (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"), F.lit(1.0).alias("c"))
    params = training.Params(rounds=5, max_depth=3, max_bins=32, feature_fraction=1.0)
    vectors = training.vectorize(rows, ["a", "b", "c"], ("active_days",))
    models = [training.fit_one(vectors.where(f"cast(did as int) % 2 = {k}"), "active_days", None, params) for k in (0, 1)]
    got = {r.Feature: r for r in training.importance_table(models, ["a", "b", "c"]).collect()}
    for fold, model in enumerate(models):
        named = [int(line.split()[2]) for line in model.toDebugString.splitlines() if line.split()[:1] == ["If"]]
        for at, name in enumerate("abc"):
            assert got[name][f"importance_{fold}"] == named.count(at)
            assert (got[name][f"importance_gain_{fold}"] > 0) == (at in named)
    assert training.importance_table(models, ["a", "b", "c"]).first().Feature == "a"


def test_deviation_of_attached_values_keeps_its_digits(spark):
    """Large counts that differ by little, each for many rows, against the deviation of the rows written out."""
    import statistics

    from tidemark.functions import moments
    from tidemark.plans.features import _repeated

    rng = random.Random(2)
    for base in (10**9, 10**12):
        rows = [("u", "test", d, base + rng.randint(0, 2), rng.randint(1, 9), 1.0) for d in (1, 7) for _ in range(60)]
        opened = spark.createDataFrame(rows, "did string, split string, days int, k long, n long, w double")
        parts = {"k": moments.needed(["std"])}
        for crowded in (False, True):
            got = _repeated(opened, parts, {}, crowded).selectExpr("days", f"{moments.statistic('std', 'k')} AS std").collect()
            for r in got:
                want = statistics.stdev([x[3] - base for x in rows if x[2] == r.days for _ in range(x[4])])
                assert abs(r["std"] - want) < 1e-6 * want


def test_written_tables_are_removed(spark):
    import os

    from tidemark import session

    path = new_path(spark, "t-gone")
    spark.range(3).write.parquet(path)
    before, session._MADE[spark.sparkContext.applicationId] = session._MADE[spark.sparkContext.applicationId], [path]
    try:
        assert os.path.isdir(path) and session.release(spark) == 1 and not os.path.exists(path)
    finally:
        session._MADE[spark.sparkContext.applicationId] = before
