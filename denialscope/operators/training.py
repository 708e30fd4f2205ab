"""Model training, cross-validation, selection and the deploy gate.

The linear model is MLlib's (L-BFGS over partitions), the forest ``forest``'s,
fitted side by side; the boosted candidates are
``boosting``'s, all folds and both candidates of them in one run whose passes
serve every fit. Folds are a column computed once (stratified, seeded hash order via
two-level prefix sums — no single-partition window), and the training frame
is checkpointed to the shared folder before the loop so every fit re-reads
the same materialised rows, in partitions of about ``ROWS_PER_PARTITION``:
tree learners run one small job a level, so the number of tasks should follow
the rows and not the cores. Rows without a label take no part.
"""

from __future__ import annotations

import hashlib
import inspect
import math
import sys
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path
from ..sources import files
from ..sources.schema import FEATURE_COLUMNS
from . import boosting as B
from . import forest as FO
from . import metrics as M
from . import prefix
from .prefix import hash_order_key, running_sums

LABEL = "label"
WEIGHT = "weight"
SEED = 42
N_FOLDS = 5
ROWS_PER_PARTITION = 100_000
ROWS_A_CORE = 1_000_000  # rows (of some 200 bytes) that fits side by side hold in memory
METRICS = ("auc", "precision", "recall", "f1", "accuracy")

# FIXED VALUES — candidate model configurations (reference hyper-parameters).
MODEL_CONFIGS = {
    "LogisticRegression": {"kind": "lr", "maxIter": 1000, "C": 1.0, "weights": "balanced"},
    "RandomForest": {"kind": "rf", "numTrees": 200, "maxDepth": 12, "minInstancesPerNode": 10,
                     "weights": "balanced"},
    "BoostedTrees": {"kind": "boost", "rounds": 300, "depth": 8, "rate": 0.05, "rows": 0.8, "columns": 0.8,
                     "reg_lambda": 1.0, "min_child_weight": 1.0, "bins": 64, "weights": "pos_weight"},
    "BoostedTreesFast": {"kind": "boost", "rounds": 300, "depth": 8, "leaves": 31, "rate": 0.05, "rows": 0.8, "columns": 0.8,
                         "reg_lambda": 0.0, "min_child_weight": 1e-3, "min_child_rows": 20, "bins": 255, "weights": "pos_weight"},
}


def class_counts(df: DataFrame, label: str = "is_denied") -> tuple[int, int]:
    row = df.agg(F.sum((F.col(label) == 0).cast("long")).alias("neg"),
                 F.sum((F.col(label) == 1).cast("long")).alias("pos")).first()
    return int(row["neg"] or 0), int(row["pos"] or 0)


def class_weight_table(df: DataFrame, label: str = "is_denied") -> DataFrame:
    """L1: per class, count, balanced weight n/(2·n_c) and pos_weight form.
    (The window spans the per-class counts: two rows.)"""
    whole = Window.partitionBy()
    n = F.sum("n").over(whole)
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    neg = F.sum(F.when(F.col(label) == 0, F.col("n"))).over(whole)
    pos = F.sum(F.when(F.col(label) == 1, F.col("n"))).over(whole)
    return counts.select(label, "n", (n / (2.0 * F.col("n"))).alias("balanced_weight"),
                         F.when(F.col(label) == 1, neg / pos).otherwise(F.lit(1.0)).alias("pos_weight"))


def labelled(df: DataFrame, label: str = "is_denied") -> DataFrame:
    return df.where(F.col(label).isNotNull())


def with_weights(df: DataFrame, mode: str, label: str = "is_denied", counts: tuple[int, int] | None = None) -> DataFrame:
    """Labelled rows with ``weight``: ``balanced`` (n/(2·n_c)) or ``pos_weight``
    (neg/pos on positives, 1 on negatives). ``counts`` (negatives, positives)
    saves the aggregate where they are known."""
    df = labelled(df, label)
    neg, pos = counts or class_counts(df, label)
    n = neg + pos
    y = F.col(label)
    if mode == "balanced":
        w = F.when(y == 1, F.lit(n / (2.0 * pos) if pos else 1.0)).otherwise(F.lit(n / (2.0 * neg) if neg else 1.0))
    elif mode == "pos_weight":
        w = F.when(y == 1, F.lit(neg / pos if pos else 1.0)).otherwise(F.lit(1.0))
    else:
        w = F.lit(1.0)
    return df.withColumn(WEIGHT, w).withColumn(LABEL, y.cast("double"))


def total_weight(mode: str, counts: tuple[int, int]) -> float:
    """Sum of the weights that ``with_weights`` gives."""
    neg, pos = counts
    if mode == "pos_weight":
        return float(2 * neg if pos else neg)
    return float(neg + pos)


def training_frame(df: DataFrame, label: str = "is_denied", side_by_side: int = 1, n_rows: int | None = None) -> DataFrame:
    """Labelled rows, written once in partitions sized by rows, or, where
    those are few, by the cores that each of ``side_by_side`` fits can have.
    ``n_rows``, where known, saves the count. The copy is Parquet, several
    times smaller than a checkpoint's rows."""
    rows = labelled(df, label)
    spark = df.sparkSession
    n = max(math.ceil((rows.count() if n_rows is None else n_rows) / ROWS_PER_PARTITION), spark.sparkContext.defaultParallelism // side_by_side, 1)
    return files.materialize_alone(rows.repartition(n), scratch_path(spark, f"training-frames/{uuid.uuid4().hex}"))


def stratified_folds(df: DataFrame, label: str = "is_denied", key: str = "claim_id",
                     k: int = N_FOLDS, seed: int = SEED, written: bool = False) -> DataFrame:
    """fold = (rank within class in md5(key‖seed) order) mod k, so fold
    sizes differ by at most one per class. Ranks come from per-class
    two-level prefix sums (no window over a whole class). ``written`` says that
    ``df`` is a stored table, which need not be written again."""
    bkey, order = hash_order_key(key, str(seed))
    keyed = df.withColumn("__hk", bkey).withColumn("__one", F.lit(1))
    ranked = running_sums(keyed, "__hk", ["__one"], order_cols=order, group_cols=(label,), written=written)
    return ranked.withColumn("fold", ((F.col("cum___one") - 1) % k).cast("int")).drop("__hk", "__one", "cum___one")


def ordered_folds(df: DataFrame, order_col: str = "service_date", key: str = "claim_id",
                  k: int = N_FOLDS, label: str = "is_denied", written: bool = False) -> DataFrame:
    """Unshuffled stratified k-fold — per class, contiguous blocks in
    (date, hash of the id) order, nulls first. The hash spreads a busy day
    over many ranges."""
    sizes = {r[0]: r[1] for r in df.groupBy(label).count().collect()}
    hashed, order = hash_order_key(key, "ordered")
    day = F.coalesce(F.unix_date(F.col(order_col)).cast("double"), F.lit(-1e6))
    keyed = df.withColumn("__dk", day + hashed / float(16 ** 13)).withColumn("__one", F.lit(1))
    ranked = running_sums(keyed, "__dk", ["__one"], order_cols=[F.col(order_col).asc_nulls_first(), *order], group_cols=(label,), written=written)
    n = F.lit(None).cast("long")
    for value, count in sizes.items():
        n = F.when(F.col(label).eqNullSafe(F.lit(value)), F.lit(count)).otherwise(n)
    fold = F.floor((F.col("cum___one") - 1) * k / n).cast("int")
    return ranked.withColumn("fold", fold).drop("__dk", "__one", "cum___one")


#: Settings of forests that no configuration has.
TREES = {"bins": 32}


def build_estimator(config: dict, n_weight: float | None = None):
    reg = 1.0 / (config.get("C", 1.0) * n_weight) if n_weight else 0.0
    return LogisticRegression(maxIter=config["maxIter"], regParam=reg, elasticNetParam=0.0, standardization=False,
                              featuresCol="features", labelCol=LABEL, weightCol=WEIGHT)


def pipeline(config: dict, n_weight: float | None = None) -> Pipeline:
    assembler = VectorAssembler(inputCols=FEATURE_COLUMNS, outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[assembler, build_estimator(config, n_weight=n_weight)])


def boosted(config: dict) -> bool:
    return config["kind"] == "boost"


def boosted_fits(mi: DataFrame, configs: dict, folds: list[int], counts: dict | None = None, label: str = "is_denied",
                 fold_col: str = "fold") -> dict:
    """(name, fold) → model, all of them trained in one run. ``folds`` are the
    folds to leave out (``REFIT``: none); ``counts`` are ``fold_counts``."""
    if counts is None:
        counts = {REFIT - 1: class_counts(mi, label)}
    fits, names = [], []
    for name, config in configs.items():
        params = B.Params(seed=SEED, **{k: v for k, v in config.items() if k not in ("kind", "weights")})
        for f in folds:
            neg, pos = without(counts, f)
            weight = neg / pos if pos and config["weights"] == "pos_weight" else 1.0
            fits.append(B.Fit(params, B.ALL_ROWS if f == REFIT else f, weight))
            names.append((name, f))
    models = B.boost(mi, FEATURE_COLUMNS, fits, label, fold_col if fold_col in mi.columns else None)
    return dict(zip(names, models))


def fit(mi: DataFrame, config: dict, label: str = "is_denied", counts: tuple[int, int] | None = None):
    """Fit one configuration on a model-input frame with a label."""
    if boosted(config):
        return boosted_fits(labelled(mi, label), {"model": config}, [REFIT], None if counts is None else {REFIT - 1: counts}, label)["model", REFIT]
    counts = counts or class_counts(mi, label)
    if config["kind"] == "rf":
        p = FO.Params(config["numTrees"], config["maxDepth"], config["minInstancesPerNode"], seed=SEED, **TREES)
        weights = tuple(sum(counts) / (2.0 * c) if c and config["weights"] == "balanced" else 1.0 for c in counts)
        return PipelineModel([FO.forest(labelled(mi, label), FEATURE_COLUMNS, p, weights, label)])
    data = with_weights(mi.na.fill(0, subset=FEATURE_COLUMNS), config["weights"], label, counts)
    return pipeline(config, total_weight(config["weights"], counts)).fit(data)


def score(model, mi: DataFrame) -> DataFrame:
    rows = mi.na.fill(0, subset=FEATURE_COLUMNS)
    if isinstance(model, B.BoostedModel):
        return model.transform(rows, "p_denial").withColumn("predicted", (F.col("p_denial") > 0.5).cast("int"))
    out = model.transform(rows)
    return (out.withColumn("p_denial", vector_to_array("probability")[1])
            .withColumn("predicted", F.col("prediction").cast("int"))
            .drop("features", "rawPrediction", "probability", "prediction"))


def save_model(spark, model, path: str) -> None:
    """Write a fitted model, replacing what is at ``path``."""
    if isinstance(model, B.BoostedModel):
        model.save(spark, path)
    else:
        model.write().overwrite().save(path)


def load_model(spark, path: str):
    """A model that ``save_model`` wrote."""
    if files.exists(spark, files.join_path(path, "boosted")):
        return B.BoostedModel.load(spark, path)
    return PipelineModel.load(path)


def fold_metrics(scored: DataFrame, label: str = "is_denied") -> dict:
    """The five metrics of a scored fold; the model runs over it once."""
    scored = cut_lineage(scored.select(label, "predicted", "p_denial"))
    cm = M.classification_metrics(M.confusion_matrix(scored, label, "predicted")).first().asDict()
    cm["auc"] = M.auc(scored, label, "p_denial").first()[0]
    return cm


def fold_counts(mi: DataFrame, label: str = "is_denied", fold_col: str = "fold") -> dict:
    """fold → (negatives, positives), in one aggregate."""
    rows = mi.groupBy(fold_col).agg(F.sum((F.col(label) == 0).cast("long")).alias("neg"), F.sum((F.col(label) == 1).cast("long")).alias("pos")).collect()
    return {r[0]: (int(r["neg"] or 0), int(r["pos"] or 0)) for r in rows}


def without(counts: dict, fold: int) -> tuple[int, int]:
    return tuple(sum(c[i] for f, c in counts.items() if f != fold) for i in (0, 1))


def side_by_side(rows: int, cores: int, k: int = N_FOLDS) -> int:
    """How many of ``k`` fits over ``rows`` run at a time: as many as hold, all
    together, no more than ``ROWS_A_CORE``."""
    return max(1, min(k, cores * ROWS_A_CORE // max(rows, 1)))


def cross_validate(mi: DataFrame, config: dict, name: str, label: str = "is_denied",
                   fold_col: str = "fold", k: int = N_FOLDS, parallelism: int | None = None, rival=None, models: dict | None = None) -> list[tuple]:
    """Per fold, fit on the other folds and score the held-out fold.

    Folds are fitted concurrently from driver threads (like CrossValidator's
    ``parallelism``): each fit is a series of small distributed jobs, so
    running them side by side keeps the cluster busy between job barriers.
    Every fit holds its rows in memory, so of large tables fewer run at a time
    (``side_by_side``).
    Boosted folds are trained in one run, which ``models`` may bring.
    A fitted ``rival`` is scored on the same held-out folds (``rival_auc``)."""
    counts = fold_counts(mi, label, fold_col)
    parallelism = parallelism or side_by_side(sum(map(sum, counts.values())), mi.sparkSession.sparkContext.defaultParallelism, k)
    if models is None and boosted(config):
        models = {f: m for (_, f), m in boosted_fits(mi, {name: config}, list(range(k)), counts, label, fold_col).items()}

    def one(f):
        test = mi.where(F.col(fold_col) == f)
        model = models[f] if models else fit(mi.where(F.col(fold_col) != f), config, label, without(counts, f))
        m = fold_metrics(score(model, test), label)
        rows = [(name, f, metric, float(m[metric]) if m[metric] is not None else None) for metric in METRICS]
        if rival is not None:
            rows.append((name, f, "rival_auc", M.auc(score(rival, test), label, "p_denial").first()[0]))
        return rows

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        results = list(pool.map(one, range(k)))
    return [r for rows in results for r in rows]


def mean_metric(rows: list[tuple], name: str, metric: str) -> float | None:
    values = [v for n, _, m, v in rows if n == name and m == metric and v is not None]
    return sum(values) / len(values) if values else None


def feature_importance(model) -> list[tuple[str, float]]:
    """Tree importances, or |coefficients| for a linear model."""
    if isinstance(model, B.BoostedModel):
        return model.importances()
    est = model.stages[-1]
    if hasattr(est, "featureImportances"):
        vals = est.featureImportances.toArray()
    else:
        vals = [abs(v) for v in est.coefficients.toArray()]
    return [(f, float(v)) for f, v in zip(FEATURE_COLUMNS, vals)]


def deploy_decision(candidate_auc: float, production_auc: float | None, min_gain: float = 0.005) -> dict:
    """Deploy only if the candidate beats production by more than
    ``min_gain`` (strict); no production model counts as AUC 0."""
    prod = production_auc if production_auc is not None else 0.0
    gain = candidate_auc - prod
    return {"candidate_auc": candidate_auc, "production_auc": prod, "improvement": gain,
            "deploy": gain > min_gain}


def promote(spark, models_dir: str, model, run_date: str) -> str:
    """Save the model under a path of its own and name it as the promoted one.
    Earlier versions stay, so the one before is the backup whatever is run
    again; the row that names a version is appended once it is complete."""
    path = files.join_path(models_dir, "versions", f"{run_date}-{uuid.uuid4().hex}")
    save_model(spark, model, path)
    row = spark.createDataFrame([(time.time(), run_date, path)], PROMOTIONS)
    row.coalesce(1).write.mode("append").json(files.join_path(models_dir, "promotions"))
    return path


PROMOTIONS = "at DOUBLE, run_date STRING, path STRING"


def promotions(spark, models_dir: str) -> list[str]:
    """Paths of the promoted versions, the latest first (one a promotion)."""
    where = files.join_path(models_dir, "promotions")
    if not files.exists(spark, where):
        return []
    return [r.path for r in spark.read.schema(PROMOTIONS).json(where).orderBy(F.desc("at")).collect()]


def promoted_path(spark, models_dir: str) -> str | None:
    return next(iter(promotions(spark, models_dir)), None)


RESULTS = "model STRING, fold INT, metric STRING, value DOUBLE, seconds DOUBLE, path STRING"
REFIT = -1  # in place of a fold: the fit on all rows


def run_name(rows: str, configs: dict) -> str:
    """Name of a training run's store: the rows, the configurations, and all
    that decides the fits, the training code itself among them."""
    code = [inspect.getsource(m) for m in (sys.modules[__name__], B, FO, M, prefix)]
    return hashlib.sha256(repr((rows, sorted(configs.items()), SEED, N_FOLDS, sorted(TREES.items()), code)).encode()).hexdigest()


def train_all_models(mi: DataFrame, label: str = "is_denied", configs: dict = MODEL_CONFIGS,
                     save_path: str | None = None, parallelism: int = 8, store: str | None = None) -> dict:
    """CV every configuration, refit on all rows, pick the best mean CV
    AUC (first wins ties), optionally save the winner (S15).

    Every finished fit is appended to ``store``; a run that finds results of
    the same ``store`` there goes on from them, so a lost driver costs only
    the fits under way. ``timing`` tells how many of a candidate's fold fits
    came from the store; their seconds are those of the run that made them."""
    spark = mi.sparkSession
    store = store or scratch_path(spark, f"training/{uuid.uuid4().hex}")
    results = files.join_path(store, "results")

    def stored() -> DataFrame:
        if not files.exists(spark, results):
            return spark.createDataFrame([], RESULTS)
        return spark.read.schema(RESULTS).json(f"{results}/*")

    done = {(r[0], r[1]) for r in stored().select("model", "fold").distinct().collect()}
    # The longest first, so that no core waits for one at the end.
    order = sorted(configs, key=lambda n: configs[n]["kind"] != "rf")
    tasks = [(n, f) for n in order for f in (REFIT, *range(N_FOLDS)) if (n, f) not in done]
    if tasks:
        # Reliable checkpoint into the shared folder: 24 fits re-read these
        # rows, and a lost executor must not send them back to the raw claims.
        data = training_frame(stratified_folds(labelled(mi, label), label), label, min(parallelism, len(tasks)))
        counts = fold_counts(data, label)

    ready = {}
    shared = [t for t in tasks if boosted(configs[t[0]])]
    if shared:
        t0 = time.time()
        by_folds: dict = {}
        for n in order:
            by_folds.setdefault(tuple(f for m, f in shared if m == n), []).append(n)
        for folds, names in by_folds.items():
            if folds:
                ready |= boosted_fits(data, {n: configs[n] for n in names}, list(folds), counts, label)
        each = (time.time() - t0) / len(shared)  # the passes serve all of them
        tasks.sort(key=lambda t: t not in ready)  # what is fitted is scored and stored before other fits start

    def run(task):
        name, f = task
        t0 = time.time() - (each if task in ready else 0)
        model = ready.get(task) or fit(data.where(F.col("fold") != f), configs[name], label, without(counts, f))
        path = None
        if f == REFIT:
            path = files.join_path(store, "models", f"{name}-{uuid.uuid4().hex}")
            save_model(spark, model, path)
            values = feature_importance(model)
        else:
            m = fold_metrics(score(model, data.where(F.col("fold") == f)), label)
            values = [(k, float(m[k]) if m[k] is not None else None) for k in METRICS]
        rows = [(name, f, k, v, time.time() - t0, path) for k, v in values]
        # a folder of its own: writers of one folder would meet in its temporary files
        spark.createDataFrame(rows, RESULTS).coalesce(1).write.json(f"{results}/{name}-{f}-{uuid.uuid4().hex}")

    # Every other fit is independent: run them side by side so that many small
    # MLlib jobs overlap on the cluster.
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        list(pool.map(run, tasks))
    rows = [r for r in stored().dropDuplicates(["model", "fold", "metric"]).collect() if r.model in configs]
    metrics = [(r.model, r.fold, r.metric, r.value) for r in rows if r.fold != REFIT]
    seconds = {(r.model, r.fold): r.seconds for r in rows if r.fold != REFIT}
    paths = {r.model: r.path for r in rows if r.fold == REFIT}
    best_name, best_auc, summary = None, float("-inf"), []
    for name in configs:  # dictionary order: the earlier candidate wins ties
        mean_auc = mean_metric(metrics, name, "auc")
        kept = sum(n == name and f != REFIT for n, f in done)
        summary.append((name, mean_auc, sum(x for (n, _), x in seconds.items() if n == name), kept))
        if mean_auc is not None and mean_auc > best_auc:
            best_name, best_auc = name, mean_auc
    if save_path and best_name is not None:
        save_model(spark, load_model(spark, paths[best_name]), save_path)
    return {"metrics": spark.createDataFrame(metrics, "model STRING, fold INT, metric STRING, value DOUBLE"),
            "best_model": best_name, "best_auc": best_auc, "paths": paths,
            "importance": spark.createDataFrame([(r.model, r.metric, r.value) for r in rows if r.fold == REFIT],
                                                "model STRING, feature STRING, importance DOUBLE"),
            "timing": spark.createDataFrame(summary, "model STRING, mean_auc DOUBLE, training_time DOUBLE, stored_fits INT")}


def cv_summary(metrics: DataFrame) -> DataFrame:
    """Mean and population std of each CV metric per model."""
    return metrics.groupBy("model", "metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


def model_comparison(metrics: DataFrame, timing: DataFrame | None = None) -> DataFrame:
    """One row per model with mean CV metrics (and training time, and how
    many of its fits were taken from an earlier run)."""
    piv = (metrics.groupBy("model").pivot("metric", ["auc", "precision", "recall", "f1", "accuracy"])
           .agg(F.avg("value")))
    return piv.join(timing.select("model", "training_time", "stored_fits"), on="model", how="left") if timing is not None else piv


def best_model(metrics: DataFrame, order: list[str]) -> DataFrame:
    """Highest mean CV AUC; the earlier candidate wins ties."""
    pos = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
    return (metrics.where(F.col("metric") == "auc").groupBy("model").agg(F.avg("value").alias("mean_auc"))
            .orderBy(F.desc("mean_auc"), pos).limit(1))
