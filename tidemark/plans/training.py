"""Fold assignment, boosted-tree fitting, out-of-fold and test scoring.

The sample table is read once into one vector per row and written to the shared folder;
all fits read that, through executors' storage while they run. Trees are grown by ``pyspark.ml`` from binned statistics merged over
the executors, so no task or driver ever holds the training rows. Where rows are held out, the error
after each round is taken on them in one pass and the ensemble is cut at its best round. Importances
are sums over the stored models' node tables. A level of a tree is a small job, and each part of the
rows has a table of statistics for every open node of it: rows are held in as few parts as their size
allows, and as many fits run side by side as fill the session's cores.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, replace
from functools import partial
from threading import Event, Thread

from pyspark import inheritable_thread_target
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ranks import even_folds, value_codes
from tidemark.operators.scoring import clip_predictions, composite_score, prediction_columns, r2_scores
from tidemark.plans.samples import feature_columns
from tidemark.session import new_path, settle
from tidemark.sources.schema import LABELS

MISSING = -1e6  # below all data: trees can split missing values off
PART_BYTES = 128 << 20  # of vectors in a part of the rows that fits pass over


@dataclass(frozen=True)
class Params:
    rounds: int = 250
    learning_rate: float = 0.15
    max_depth: int = 8  # 256 leaves when grown level by level
    max_bins: int = 255
    feature_fraction: float = 0.5
    patience: int = 50  # rounds without a smaller error on held-out rows, after which none is looked for
    seed: int = 2023
    folds: int = 5
    fold_seed: int = 42


PARAMS_1 = Params()
PARAMS_2 = Params(rounds=3000)
BASELINE_PARAMS = Params(rounds=3000, learning_rate=0.05, feature_fraction=1.0, patience=100, seed=114)


def assign_folds(df: DataFrame, key: str | list[str] = "did", k: int = 5, seed: int = 42) -> DataFrame:
    """Fold of each row from a hash of its key: no order, no state, repeatable.

    By user, all rows of a user share a fold; with ``["split", "did"]`` rows are dealt
    independently, as a shuffled k-fold does.
    """
    keys = [key] if isinstance(key, str) else key
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in keys])
    eight = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    return df.withColumn("fold", F.pmod(eight, F.lit(k)).cast("int"))


def vectorize(df: DataFrame, features: list[str], labels=LABELS) -> DataFrame:
    """Key columns, labels and one dense feature vector per row."""
    values = ", ".join(f"CAST(coalesce(`{c}`, {MISSING}D) AS DOUBLE)" for c in features)
    keep = [c for c in ("split", "did", "fold", *labels) if c in df.columns]
    return df.select(*keep, array_to_vector(F.expr(f"array({values})")).alias("features"))


def numeric_features(df: DataFrame) -> list[str]:
    text = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
    return [c for c in feature_columns(df) if c not in text]


def number_texts(df: DataFrame, learned: DataFrame) -> DataFrame:
    """Text features as the rank of their value's frequency in ``learned``, ties by value; new and missing ones last.

    Each dictionary is a table that is joined, however many values it has.
    """
    text = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string" and f.name in feature_columns(df)]
    out = df
    for c in text:
        codes = value_codes(learned, c)
        last = codes.count()
        codes = codes.select(F.col("value").alias("_value"), F.col("code").cast("double").alias("_code"))
        out = out.join(codes, F.col(f"`{c}`") == F.col("_value"), "left").withColumn("_code", F.coalesce("_code", F.lit(float(last))))
        out = out.drop("_value", c).withColumnRenamed("_code", c)
    return out


def _booster(label: str, params: Params, rounds: int) -> GBTRegressor:
    return GBTRegressor(
        labelCol=label, featuresCol="features", predictionCol="prediction",
        maxIter=rounds, stepSize=params.learning_rate, maxDepth=params.max_depth,
        maxBins=params.max_bins, seed=params.seed,
        featureSubsetStrategy="all" if params.feature_fraction >= 1 else str(params.feature_fraction),
    )


def best_round(errors: list[float], patience: int) -> tuple[int, bool]:
    """The round, from 1, of the smallest error before ``patience`` rounds brought none smaller, and whether they did so."""
    best = 0
    for at, error in enumerate(errors):
        if error < errors[best]:
            best = at
        elif at - best >= patience:
            return best + 1, True
    return best + 1, False


def cut(model: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The model of the first ``rounds`` trees."""
    if rounds >= model.getNumTrees:
        return model
    context, whole = SparkSession.active().sparkContext, model._java_obj
    made = context._jvm.org.apache.spark.ml.regression
    trees = context._gateway.new_array(made.DecisionTreeRegressionModel, rounds)
    weights = context._gateway.new_array(context._jvm.double, rounds)
    for k, (tree, weight) in enumerate(zip(whole.trees()[:rounds], model.treeWeights[:rounds], strict=True)):
        trees[k], weights[k] = tree, float(weight)
    return GBTRegressionModel(made.GBTRegressionModel(f"{whole.uid()}-{rounds}", trees, weights))


def fit_one(rows: DataFrame, label: str, held_out: str | None, params: Params) -> GBTRegressionModel:
    """One model; ``held_out`` is a condition naming the rows that say at which round to stop.

    Rounds are grown in runs, each twice as long as the one before, until ``patience`` rounds
    after the best one are seen or all are. A run repeats the rounds before it and goes on, so how
    long the runs are does not show in the model. A run that nearly reaches the last round has it, too.
    """
    kept = rows.where(F.col(label).isNotNull())
    if held_out is None:
        return _booster(label, params, params.rounds).fit(kept)
    held = F.coalesce(F.expr(held_out), F.lit(False))
    learned, asked = kept.where(~held), kept.where(held)
    if asked.isEmpty():
        return _booster(label, params, params.rounds).fit(learned)
    rounds = min(params.rounds, params.patience + max(1, params.patience // 5))
    while True:
        model = _booster(label, params, rounds).fit(learned)
        best, settled = best_round(model.evaluateEachIteration(asked, "squared"), params.patience)
        if settled or rounds >= params.rounds:
            return cut(model, best)
        rounds = params.rounds if 5 * rounds >= 2 * params.rounds else 2 * rounds


def _parts(df: DataFrame) -> int:
    return df._jdf.rdd().getNumPartitions()


def _side_by_side(spark: SparkSession, calls: list[Callable], tasks: int) -> list:
    """What ``calls`` return, in their order; as many run at once as have a core for each of their ``tasks``."""
    at_once = min(len(calls), max(1, spark.sparkContext.defaultParallelism // tasks))
    with ThreadPoolExecutor(at_once) as pool:
        asked = [pool.submit(inheritable_thread_target(spark)(call)) for call in calls]
        try:
            return [one.result() for one in asked]
        except BaseException:
            pool.shutdown(wait=False, cancel_futures=True)
            raise


@contextmanager
def _swept(spark: SparkSession, every: float = 10) -> Iterator[None]:
    """Asks the driver's JVM to collect its garbage ``every`` so many seconds.

    Spark deletes the shuffle files of a level of a tree when the driver no longer has its objects, and
    looks for such by itself every half an hour: in between, the files of many rounds would fill the disk.
    """
    done = Event()

    def sweep():
        while not done.wait(every):
            spark.sparkContext._jvm.System.gc()

    thread = Thread(target=sweep, daemon=True)
    thread.start()
    try:
        yield
    finally:
        done.set()
        thread.join()


@dataclass
class Fitted:
    """Models of one label, one per fold, with out-of-fold predictions."""

    label: str
    models: list[GBTRegressionModel]
    oof: DataFrame


def fit_oof(rows: DataFrame, label: str, params: Params) -> Fitted:
    """One model per fold; a row is scored by the model that did not train on it."""
    fits = [partial(fit_one, rows, label, f"fold = {fold}", params) for fold in range(params.folds)]
    models, parts = _side_by_side(rows.sparkSession, fits, _parts(rows)), []
    for fold, model in enumerate(models):
        scored = model.transform(rows.where(F.col("fold") == fold))
        parts.append(scored.select(
            "split", "did", "fold", F.col(label).cast("double").alias(label),
            F.col("prediction").alias(f"{label}_preds"),
        ))
    oof = parts[0]
    for part in parts[1:]:
        oof = oof.unionByName(part)
    return Fitted(label, models, oof)


def score_test(test: DataFrame, fitted: Fitted) -> DataFrame:
    """Mean over the fold models' predictions, model by model on the same row."""
    out = test
    for i, model in enumerate(fitted.models):
        out = model.copy({model.predictionCol: f"_p{i}"}).transform(out)
    total = sum((F.col(f"_p{i}") for i in range(len(fitted.models))), F.lit(0.0))
    return out.withColumn(fitted.label, total / len(fitted.models)).drop(
        *[f"_p{i}" for i in range(len(fitted.models))]
    )


@dataclass
class Trained:
    fits: dict[str, Fitted]
    test: DataFrame
    features: list[str]

    def scores(self) -> DataFrame:
        """R² per label on the out-of-fold predictions, and their composite."""
        out = None
        for label, fit in self.fits.items():
            one = r2_scores(fit.oof, {label: f"{label}_preds"}).withColumn("_k", F.lit(1))
            out = one if out is None else out.join(one, "_k")
        return composite_score(out.drop("_k"))

    def predictions(self) -> DataFrame:
        scored = self.test
        for fit in self.fits.values():
            scored = score_test(scored, fit)
        return clip_predictions(prediction_columns(scored))

    def importance(self, label: str) -> DataFrame:
        return importance_table(self.fits[label].models, self.features)


def train(train_rows: DataFrame, test_rows: DataFrame, params: Params = PARAMS_1,
          fold_key: str | list[str] = "did", labels=LABELS) -> Trained:
    """Folds, a model per label and fold, and the test rows ready to score."""
    features = numeric_features(train_rows)
    folded = even_folds(train_rows, fold_key, params.folds, params.fold_seed)
    rows = settle(vectorize(folded, features, labels), "train-vectors")
    test = settle(vectorize(test_rows, features, ()), "test-vectors")
    if params.max_depth > 1:  # a tree of one split has one table of statistics in a part
        rows = rows.coalesce(max(1, -(-rows.count() * len(features) * 8 // PART_BYTES)))
    # every fit passes over the vectors several times: kept in memory and on local disk while fits run
    rows.persist()
    try:
        with _swept(rows.sparkSession):
            fits = _side_by_side(rows.sparkSession, [partial(fit_oof, rows, y, params) for y in labels], _parts(rows) * params.folds)
        return Trained(dict(zip(labels, fits, strict=True)), test, features)
    finally:
        rows.unpersist()


def fit_holdout(rows: DataFrame, label: str, params: Params, valid: str = "valid") -> tuple[GBTRegressionModel, DataFrame]:
    """Train on the earlier splits, stop on ``valid``; the model and the scored rows."""
    model = fit_one(rows, label, f"split = '{valid}'", params)
    scored = model.transform(rows.where(F.col("split") == valid))
    return model, scored.select(
        "split", "did", F.col(label).cast("double").alias(label),
        F.col("prediction").alias(f"{label}_preds"),
    )


def refit_and_score(
    rows: DataFrame, test: DataFrame, tuned: dict[str, GBTRegressionModel], params: Params,
    valid: str = "valid",
) -> DataFrame:
    """Refit each label on the newest split with its tuned round count, then score test.

    No early stopping here: the only held-out rows would be the training rows.
    """
    newest = rows.where(F.col("split") == valid)
    out = test
    for label, model in tuned.items():
        again = fit_one(newest, label, None, replace(params, rounds=model.getNumTrees))
        out = again.setPredictionCol(label).transform(out)
    return prediction_columns(out)


def node_table(models: list[GBTRegressionModel]) -> DataFrame:
    """One row per split of the models' trees: fold, tree, node, feature (by place), rows and gain.

    Models are stored and their node tables read; ``gain`` is the squared error that the split
    takes away, over all its rows.
    """
    spark, out = SparkSession.active(), None
    for fold, model in enumerate(models):
        path = new_path(spark, "model")
        model.write().save(path)
        nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").where("leftChild >= 0").select(
            F.lit(fold).alias("fold"), F.col("treeID").alias("tree"), F.col("id").alias("node"), F.col("split.featureIndex").alias("feature"),
            F.col("rawCount").alias("rows"), (F.col("gain") * F.col("rawCount")).alias("gain"))
        out = nodes if out is None else out.unionByName(nodes)
    return out


def importance_table(models: list[GBTRegressionModel], features: list[str]) -> DataFrame:
    """One row per feature: for each fold's model, its splits and their gain; the most split on in the first come first."""
    spark = SparkSession.active()
    names = spark.createDataFrame(list(enumerate(features)), "_at int, Feature string")
    nodes = node_table(models)
    folds = range(len(models))
    sums = nodes.groupBy(F.col("feature").alias("_at")).agg(*[c for f in folds for c in (
        F.count_if(F.col("fold") == f).alias(f"importance_{f}"),
        F.coalesce(F.sum(F.when(F.col("fold") == f, F.col("gain"))), F.lit(0.0)).alias(f"importance_gain_{f}"))])
    columns = [c for f in folds for c in (f"importance_{f}", f"importance_gain_{f}")]
    table = names.join(sums, "_at", "left").select("Feature", *[
        F.coalesce(F.col(c), F.lit(0.0 if "gain" in c else 0)).alias(c) for c in columns])
    return table.orderBy(F.desc("importance_0"), "Feature")
