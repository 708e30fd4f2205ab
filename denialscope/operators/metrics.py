"""Binary-classifier evaluation as distributed jobs: AUC, ROC and PR curves,
average precision, calibration, confusion matrix, classification report.

Everything starts from ``score_counts`` — one row per distinct score with
positive/negative counts (a hash aggregate, so millions of rows sharing a
score collapse map-side) — and global order comes from the two-level prefix
sums in ``operators.prefix``; no step puts all rows into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

from .prefix import running_sums

INF = float("inf")


def score_counts(scored: DataFrame, label: str = "is_denied", score: str = "p_denial") -> DataFrame:
    y = F.col(label)
    return (scored.where(F.col(score).isNotNull() & y.isNotNull()).groupBy(score)
            .agg(F.sum((y == 1).cast("bigint")).alias("pos"), F.sum((y != 1).cast("bigint")).alias("neg")))


def _totals(counts: DataFrame) -> tuple[int, int]:
    row = counts.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()
    return int(row["P"] or 0), int(row["N"] or 0)


def cumulative(scored: DataFrame, label: str = "is_denied", score: str = "p_denial"):
    """Per distinct score s, tp/fp = positives/negatives with score ≥ s,
    plus ``neg_below`` (negatives strictly below s). Returns (frame, P, N)."""
    # One row per distinct score, read three times (totals, bucket bounds,
    # running sums): a reliable checkpoint in the shared folder, so the
    # scoring pipeline runs once and no executor memory stays pinned.
    counts = cut_lineage(score_counts(scored, label, score))
    P, N = _totals(counts)
    cum = running_sums(counts, score, ["pos", "neg"], written=True)
    out = cum.select(
        F.col(score).alias("threshold"), "pos", "neg",
        (F.lit(P) - F.col("cum_pos") + F.col("pos")).alias("tp"),
        (F.lit(N) - F.col("cum_neg") + F.col("neg")).alias("fp"),
        (F.col("cum_neg") - F.col("neg")).alias("neg_below"))
    return out, P, N


def auc(scored: DataFrame, label: str = "is_denied", score: str = "p_denial") -> DataFrame:
    """M1: ROC AUC with ties counted ½ (Mann–Whitney), 1-row frame."""
    cum, P, N = cumulative(scored, label, score)
    s = F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") * 0.5))
    return cum.agg((s / F.lit(float(P) * float(N)) if P and N else F.lit(None).cast("double")).alias("auc"))


def roc_curve(scored: DataFrame, label: str = "is_denied", score: str = "p_denial") -> DataFrame:
    """M2: (threshold, fpr, tpr) for every distinct score, plus (inf, 0, 0)."""
    cum, P, N = cumulative(scored, label, score)
    pts = cum.select("threshold", (F.col("fp") / F.lit(float(N))).alias("fpr"),
                     (F.col("tp") / F.lit(float(P))).alias("tpr"))
    start = scored.sparkSession.createDataFrame([(INF, 0.0, 0.0)], "threshold DOUBLE, fpr DOUBLE, tpr DOUBLE")
    return pts.unionByName(start)


def pr_curve(scored: DataFrame, label: str = "is_denied", score: str = "p_denial") -> DataFrame:
    """M3: (threshold, precision, recall) per distinct score, plus the final
    (null, 1, 0) point; precision 0 when nothing is predicted positive."""
    cum, P, N = cumulative(scored, label, score)
    ps = F.col("tp") + F.col("fp")
    prec = F.when(ps > 0, F.col("tp") / ps).otherwise(F.lit(0.0))
    rec = (F.col("tp") / F.lit(float(P))) if P else F.lit(1.0)
    pts = cum.select("threshold", prec.alias("precision"), rec.alias("recall"))
    end = scored.sparkSession.createDataFrame([(None, 1.0, 0.0)], "threshold DOUBLE, precision DOUBLE, recall DOUBLE")
    return pts.unionByName(end)


def average_precision(scored: DataFrame, label: str = "is_denied", score: str = "p_denial") -> DataFrame:
    """M4: AP = Σ (Rₙ − Rₙ₋₁)·Pₙ over thresholds, and the prevalence baseline."""
    cum, P, N = cumulative(scored, label, score)
    prec = F.col("tp") / (F.col("tp") + F.col("fp"))
    ap = F.sum(F.col("pos") * prec) / F.lit(float(P)) if P else F.lit(None).cast("double")
    prevalence = float(P) / (P + N) if (P + N) else None
    return cum.agg(ap.alias("average_precision")).withColumn("prevalence", F.lit(prevalence).cast("double"))


# FIXED VALUES — calibration edges are numpy.linspace(0, 1, 11) (interior ones).
CALIBRATION_EDGES = [i * 0.1 for i in range(1, 10)]


def calibration_curve(scored: DataFrame, label: str = "is_denied", score: str = "p_denial",
                      edges: list[float] = CALIBRATION_EDGES) -> DataFrame:
    """M5: uniform bins on [0, 1] (right-closed; bin = #interior edges < p),
    empty bins dropped: mean predicted probability and fraction positive."""
    p = F.col(score)
    b = sum((p > F.lit(e)).cast("int") for e in edges)
    return (scored.where(p.isNotNull() & F.col(label).isNotNull()).groupBy(b.alias("bin"))
            .agg(F.avg(p).alias("mean_predicted"), F.avg(F.col(label).cast("double")).alias("fraction_positive"),
                 F.count(F.lit(1)).alias("n")))


def confusion_matrix(scored: DataFrame, label: str = "is_denied", pred: str = "predicted") -> DataFrame:
    """M6: one row tn, fp, fn, tp (classes 0 = Approved, 1 = Denied)."""
    y, yh = F.col(label), F.col(pred)

    def cell(a, b):
        return F.coalesce(F.sum(((y == a) & (yh == b)).cast("bigint")), F.lit(0)).alias(
            {(0, 0): "tn", (0, 1): "fp", (1, 0): "fn", (1, 1): "tp"}[(a, b)])
    return scored.agg(cell(0, 0), cell(0, 1), cell(1, 0), cell(1, 1))


def _div(a, b):
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def classification_metrics(cm: DataFrame) -> DataFrame:
    """M7: precision, recall, F1, accuracy of class 1 (0 when undefined)."""
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    prec, rec = _div(tp, tp + fp), _div(tp, tp + fn)
    return cm.select(prec.alias("precision"), rec.alias("recall"),
                     _div(2 * prec * rec, prec + rec).alias("f1"),
                     _div(tp + tn, tp + tn + fp + fn).alias("accuracy"))


def classification_report(cm: DataFrame) -> DataFrame:
    """M8: per class, macro and weighted averages, accuracy (long form)."""
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    p1, r1 = _div(tp, tp + fp), _div(tp, tp + fn)
    p0, r0 = _div(tn, tn + fn), _div(tn, tn + fp)
    f1, f0 = _div(2 * p1 * r1, p1 + r1), _div(2 * p0 * r0, p0 + r0)
    s1, s0 = (tp + fn), (tn + fp)
    n = s0 + s1
    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("label"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.cast("double").alias("f1_score"),
                        s.cast("bigint").alias("support"))
    none = F.lit(None).cast("double")
    rows = F.array(
        row("0", p0, r0, f0, s0),
        row("1", p1, r1, f1, s1),
        row("accuracy", none, none, _div(tp + tn, n), n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        row("weighted avg", _div(p0 * s0 + p1 * s1, n), _div(r0 * s0 + r1 * s1, n), _div(f0 * s0 + f1 * s1, n), n),
    )
    return cm.select(F.inline(rows))


def evaluate(scored: DataFrame, label: str = "is_denied", score: str = "p_denial",
             threshold: float = 0.5) -> DataFrame:
    """M9: auc, precision, recall, f1, accuracy, average precision in one row,
    all from one cumulative frame (one row a distinct score)."""
    cum, P, N = cumulative(scored, label, score)
    above = F.col("threshold") >= threshold
    tp, fp, area, ap = cum.agg(
        F.coalesce(F.sum(F.when(above, F.col("pos"))), F.lit(0)), F.coalesce(F.sum(F.when(above, F.col("neg"))), F.lit(0)),
        F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") * 0.5)), F.sum(F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp"))))).first()
    spark = scored.sparkSession
    cm = spark.createDataFrame([(N - fp, fp, P - tp, tp)], "tn BIGINT, fp BIGINT, fn BIGINT, tp BIGINT")
    m = classification_metrics(cm).first()
    row = [(area / (float(P) * float(N)) if P and N else None, m["precision"], m["recall"], m["f1"], m["accuracy"], ap / float(P) if P else None)]
    return spark.createDataFrame(
        row, "auc DOUBLE, precision DOUBLE, recall DOUBLE, f1 DOUBLE, accuracy DOUBLE, average_precision DOUBLE")
