"""Folds, fitting and scoring; readers and writers; invariants of the features."""

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tidemark.operators.prepare import prepare
from tidemark.plans import samples as sampling
from tidemark.plans import training
from tidemark.plans.features import long_features
from tidemark.plans.spec import SPEC_1
from tidemark.plans.splits import SET_1, survey
from tidemark.session import new_path
from tidemark.sources import tables
from tidemark.sources.schema import BEHAVIORS
from tidemark.sources.adapters import watch_events, watch_items


@pytest.fixture(scope="module")
def planted(spark):
    """Labels that follow one of three features."""
    rows = spark.range(400).select(
        F.lit("train_1").alias("split"), F.col("id").cast("string").alias("did"),
        (F.col("id") % 7 + 1).alias("active_days"),
        (F.col("id") % 7 * 3).alias("watch_nums"),
        (F.col("id") % 7 * 10.5).alias("watch_durations"),
        (F.col("id") % 7).cast("double").alias("signal"),
        F.pmod(F.xxhash64("id"), F.lit(100)).cast("double").alias("noise"),
        F.when(F.col("id") % 3 == 0, F.col("id") * 1.0).alias("holes"),
    )
    return rows


PARAMS = training.Params(rounds=8, max_depth=3, max_bins=32, learning_rate=0.5, feature_fraction=1.0, folds=3)


def test_folds_partition_the_rows_and_keep_users_together(planted):
    folded = training.assign_folds(planted.unionByName(planted.withColumn("split", F.lit("valid"))), "did", 5)
    assert folded.count() == 800
    assert folded.groupBy("did").agg(F.count_distinct("fold").alias("n")).where("n > 1").count() == 0
    sizes = [r["count"] for r in folded.groupBy("fold").count().collect()]
    assert len(sizes) == 5 and min(sizes) > 100
    again = training.assign_folds(planted.repartition(7), "did", 5).exceptAll(training.assign_folds(planted, "did", 5))
    assert again.count() == 0


@pytest.fixture(scope="module")
def trained(planted):
    test = planted.drop("active_days", "watch_nums", "watch_durations")
    return training.train(planted, test, PARAMS, labels=("active_days", "watch_nums", "watch_durations"))


def test_out_of_fold_scores_a_planted_signal(trained, planted):
    oof = trained.fits["active_days"].oof
    assert oof.count() == planted.count()
    assert oof.select("did").distinct().count() == planted.count()
    scores = trained.scores().first()
    assert scores["r2_active_days"] > 0.9 and scores["score"] > 0.9


def test_test_predictions_are_means_of_folds_and_clipped(trained, planted):
    got = trained.predictions()
    assert got.columns == ["did", "active_days", "watch_nums", "watch_durations"]
    assert got.count() == planted.count()
    low, high = got.agg(F.min("active_days"), F.max("active_days")).first()
    assert low >= 1 and high <= 7


def test_importance_finds_the_signal(trained):
    table = trained.importance("active_days")
    assert table.count() == 3
    best = table.first()
    assert best["Feature"] == "signal" and best["importance_0"] > 0 and best["importance_gain_0"] > 0.5


def test_holdout_and_refit(planted):
    both = planted.unionByName(planted.withColumn("split", F.lit("valid")))
    features = training.numeric_features(both)
    assert features == ["signal", "noise", "holes"]
    rows = training.vectorize(both, features)
    model, scored = training.fit_holdout(rows, "active_days", PARAMS)
    assert scored.count() == 400 and 1 <= model.getNumTrees <= 8
    tuned = {y: model for y in training.LABELS}
    out = training.refit_and_score(rows, training.vectorize(planted, features, ()), tuned, PARAMS)
    assert out.count() == 400


def test_tables_round_trip(spark, planted, trained):
    path = new_path(spark, "t-samples")
    tables.write_samples(planted, path)
    back = tables.read_samples(spark, path)
    assert sorted(back.columns) == sorted(planted.columns) and back.count() == 400
    as_csv = new_path(spark, "t-csv") + ".csv"
    tables.write_samples(planted, as_csv, "csv")
    read = tables.read_samples(spark, as_csv, "csv")
    assert dict(read.dtypes)["active_days"] == "bigint" and dict(read.dtypes)["signal"] == "double"
    predictions = new_path(spark, "t-pred") + ".csv"
    tables.write_predictions(trained.predictions(), predictions)
    assert tables.read_predictions(spark, predictions).count() == 400
    importance = new_path(spark, "t-imp") + ".csv"
    tables.write_importance(trained.importance("active_days"), importance)
    assert spark.read.option("header", True).csv(importance).count() == 3


def test_texts_become_ranks(spark):
    frame = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "did long, like string")
    got = {r["did"]: r["like"] for r in training.number_texts(frame, frame.where("did < 4")).collect()}
    assert got == {1: 0.0, 2: 0.0, 3: 1.0, 4: 2.0}


def test_bad_csv_values_fail_or_are_counted(spark):
    path = new_path(spark, "t-bad") + ".csv"
    frame = spark.createDataFrame([("5", "v", "x", "u"), ("6", "w", None, "u"), ("y", "w", "1", "u")], "timestamp string, vid string, vts string, did string")
    frame.write.option("header", True).csv(path)
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            with pytest.raises(Exception, match="is no (double: x|bigint: y)"):
                tables.read_behaviors(spark, path).collect()
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")
    assert tables.read_behaviors(spark, path, strict=False).where("vts IS NULL").count() == 2
    found = tables.rejects(spark, path, BEHAVIORS).first()
    assert (found["vts"], found["timestamp"], found["vid"]) == (1, 1, 0)


def test_csv_columns_are_matched_by_name(spark):
    path = new_path(spark, "t-behaviors") + ".csv"
    frame = spark.createDataFrame([(5, "v", 1.5, "u"), (6, "w", None, "u")], "timestamp long, vid string, vts double, did string")
    frame.write.option("header", True).csv(path)
    got = tables.read_behaviors(spark, path).orderBy("timestamp").collect()
    assert [tuple(r) for r in got] == [("u", "v", 1.5, 5), ("u", "w", None, 6)]


@pytest.fixture(scope="module")
def long(spark):
    events, items = watch_events(spark, SMALL), watch_items(spark, SMALL)
    layout = survey(events, SET_1)
    some = SPEC_1.pick((3, 15, 120), lambda f: f.block in ("base", "distinct", "ratio"))
    return long_features(prepare(events, items, items.count(), layout.items), layout, some).cache()


def test_invariants(long):
    broken = long.where("""
        did_vid_nunique > did_vid_count OR did_date_nunique > days OR `did_date/days_nunique` > 1
        OR is_intact_1_vid + is_intact_2_vid + is_intact_3_vid + is_intact_4_vid > did_vid_count
        OR coalesce(is_intact_1_vts, 0) > did_vts_sum + 1e-6
        OR w95_did_vts_mean > 0.95 * did_vts_mean + 1e-9
        OR did_vts_min > did_vts_mean + 1e-9 OR did_vts_max < did_vts_mean - 1e-9
    """)
    assert long.count() > 0 and broken.count() == 0
    wider = long.alias("a").join(long.alias("b"), ["split", "did"]).where("a.days < b.days")
    assert wider.where("a.did_vid_count > b.did_vid_count OR a.did_vts_sum > b.did_vts_sum + 1e-6").count() == 0


def test_labels_and_history_do_not_overlap(spark):
    layout = survey(watch_events(spark, SMALL), SET_1, skew=False)
    for split in layout.splits:
        if split.label:
            assert split.history[1] < split.label[0] and split.anchor <= split.history[1]


def test_stack_and_feature_columns(planted):
    stacked = sampling.stack(planted, planted.drop("noise"))
    assert stacked.count() == 800
    assert sampling.feature_columns(stacked) == ["signal", "noise", "holes"]


def test_queries_train_no_less_than_before():
    from tidemark.queries import QUICK

    assert QUICK.rounds >= 4 and QUICK.max_depth >= 3 and QUICK.max_bins >= 32


def test_fits_share_stored_vectors(spark, monkeypatch):
    """All fits pass over vectors that executors hold, and hold no longer once the fits are done."""
    rows = [(s, k, k % 3, k, 0.5 * k, float(k % 7)) for k in range(40) for s in ("train_1", "test")]
    table = spark.createDataFrame(rows, "split string, did long, active_days long, watch_nums long, watch_durations double, f_1 double")
    seen, fit = [], training.fit_oof

    def watched(rows, label, params):
        seen.append((rows, rows.storageLevel.useMemory and rows.storageLevel.useDisk))
        return fit(rows, label, params)

    monkeypatch.setattr(training, "fit_oof", watched)
    trained = training.train(table.where("split <> 'test'"), table.where("split = 'test'"), training.Params(rounds=1, max_depth=1, max_bins=8, folds=2))
    assert [held for _, held in seen] == [True] * 3
    assert not seen[0][0].storageLevel.useMemory and trained.fits["watch_nums"].oof.count() == 40


@pytest.fixture
def whole_params(spark, monkeypatch):
    """Few rows instead of the wide sample, and fits of one round that note what they were asked for."""
    from tidemark import queries

    rows = [(s, str(k), k % 7 + 1, k, 0.5 * k, float(k % 7), float(k % 3)) for k in range(20) for s in ("train_1", "valid")]
    rows += [("test", str(k), None, None, None, float(k % 7), None) for k in range(30)]
    sample = spark.createDataFrame(rows, "split string, did string, active_days long, watch_nums long, watch_durations double, f_1 double, f_2 double")
    asked, fit = [], training.fit_one

    def noted(rows, label, held_out, params):
        asked.append((label, held_out, params))
        return fit(rows, label, None, training.Params(rounds=1, max_depth=1, max_bins=8, feature_fraction=1.0))

    monkeypatch.setattr(queries, "Watch", lambda *_: None)
    monkeypatch.setattr(queries, "_sample", lambda *_: sample)
    monkeypatch.setattr(training, "fit_one", noted)
    return asked


@pytest.mark.parametrize("name, rows", [("importance", 6), ("oof_predictions", 120), ("oof_scores", 1), ("test_predictions", 30)])
def test_a_query_trains_by_the_parameters_of_its_set(spark, whole_params, name, rows):
    """Every label and fold is asked for all rounds, leaves and bins of the first set (train_doufu_1.py:43-61, :103)."""
    from tidemark.queries import QUERIES

    assert QUERIES[name](spark, "").count() == rows
    assert sorted(x[:2] for x in whole_params) == sorted((y, f"fold = {k}") for y in training.LABELS for k in range(5))
    for _, _, p in whole_params:
        assert (p.rounds, 2 ** p.max_depth, p.max_bins, p.feature_fraction, p.learning_rate, p.patience) == (250, 256, 255, 0.5, 0.15, 50)


def test_fits_side_by_side_are_the_same_as_one_by_one(spark, planted):
    folded = training.assign_folds(planted, "did", 3)
    rows = training.vectorize(folded, ["signal", "noise", "holes"]).coalesce(1).cache()
    params = training.Params(rounds=5, max_depth=3, max_bins=32, feature_fraction=0.5, folds=3)
    models = training.fit_oof(rows, "watch_nums", params).models
    alone = [training.fit_one(rows, "watch_nums", f"fold = {k}", params) for k in range(3)]
    trees = [m.toDebugString.split("\n", 1)[1] for m in models]
    assert trees == [m.toDebugString.split("\n", 1)[1] for m in alone] and len(set(trees)) == 3


def test_calls_side_by_side_keep_their_order_and_fail_aloud(spark):
    assert training._side_by_side(spark, [lambda k=k: k for k in range(9)], 1) == list(range(9))
    with pytest.raises(ZeroDivisionError):
        training._side_by_side(spark, [lambda: 1, lambda: 1 // 0], 100)


@pytest.mark.parametrize("worse_from, last", [(5, 60), (30, 120), (100, 250), (999, 250)])
def test_rounds_are_grown_until_none_is_better(spark, monkeypatch, worse_from, last):
    """``worse_from``: the round after which the error on held-out rows rises."""
    grown = []

    class Model:
        def __init__(self, rounds):
            self.rounds = rounds

        def evaluateEachIteration(self, rows, loss):
            return [abs(worse_from - k) for k in range(1, self.rounds + 1)]

    class Booster:
        def __init__(self, rounds):
            self.rounds = rounds

        def fit(self, rows):
            grown.append(self.rounds)
            return Model(self.rounds)

    monkeypatch.setattr(training, "_booster", lambda label, params, rounds: Booster(rounds))
    monkeypatch.setattr(training, "cut", lambda model, rounds: (model.rounds, rounds))
    rows = spark.range(4).selectExpr("id AS y", "CAST(id % 2 AS int) AS fold")
    assert training.fit_one(rows, "y", "fold = 0", training.PARAMS_1) == (last, min(worse_from, 250))
    assert grown == [r for r in (60, 120, 250) if r <= last]


def test_driver_garbage_is_collected_while_fits_run(spark):
    import time

    def collections():
        return sum(b.getCollectionCount() for b in spark.sparkContext._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans())

    before = collections()
    with training._swept(spark, 0.2):
        until = time.time() + 20
        while collections() < before + 3 and time.time() < until:
            time.sleep(0.2)
    after = collections()
    assert after >= before + 3
    time.sleep(1)
    assert collections() == after


def test_a_tree_of_one_split_reads_its_rows_as_stored(spark, monkeypatch):
    """Sums of other parts differ in their last bits, which choose between features that split alike."""
    rows = [(s, k, k % 3, k, 0.5 * k, float(k % 7)) for k in range(40) for s in ("train_1", "test")]
    table = spark.createDataFrame(rows, "split string, did long, active_days long, watch_nums long, watch_durations double, f_1 double").repartition(8)
    seen = []
    monkeypatch.setattr(training, "fit_oof", lambda rows, label, params: seen.append(training._parts(rows)))
    for depth in (1, 2):
        training.train(table.where("split <> 'test'"), table.where("split = 'test'"), training.Params(rounds=1, max_depth=depth, max_bins=8))
    assert min(seen[:3]) > 1 and seen[3:] == [1] * 3
