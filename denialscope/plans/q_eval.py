"""Registered queries: evaluation metrics and curves (M1–M9, W3), drift and
monitoring (K1–K5, A16, A17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift as DR
from ..operators import features as FE
from ..operators import metrics as M
from ..operators import scoring as SC
from ..session import cut_lineage
from ..sources.fixtures import claims
from ..sources.schema import FEATURE_COLUMNS
from . import sqlparts as S
from .registry import register

D = S.D


def scored(spark, d):
    return SC.RuleScorer().score(FE.features_wide(claims(spark, d))).select("claim_id", "is_denied", SC.P)


# ---------------------------------------------------------------- oracle CTEs
_WIN = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_CUM = f"""cnt AS (
  SELECT p_denial AS threshold,
         CAST(SUM(CASE WHEN is_denied = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
         CAST(SUM(CASE WHEN is_denied <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS neg
  FROM sc WHERE p_denial IS NOT NULL AND is_denied IS NOT NULL GROUP BY 1
), tot AS (SELECT CAST(SUM(pos) AS BIGINT) AS P, CAST(SUM(neg) AS BIGINT) AS N FROM cnt),
cum AS (
  SELECT threshold, pos, neg,
         CAST(tot.P - SUM(pos) OVER (ORDER BY threshold {_WIN}) + pos AS BIGINT) AS tp,
         CAST(tot.N - SUM(neg) OVER (ORDER BY threshold {_WIN}) + neg AS BIGINT) AS fp,
         CAST(SUM(neg) OVER (ORDER BY threshold {_WIN}) - neg AS BIGINT) AS neg_below,
         tot.P AS P, tot.N AS N
  FROM cnt, tot
)"""
_PRED = "pr AS (SELECT *, CASE WHEN p_denial >= 0.5 THEN 1 ELSE 0 END AS predicted FROM sc)"
_CM = ("cm AS (SELECT "
       "CAST(coalesce(SUM(CASE WHEN is_denied = 0 AND predicted = 0 THEN 1 ELSE 0 END), 0) AS BIGINT) AS tn, "
       "CAST(coalesce(SUM(CASE WHEN is_denied = 0 AND predicted = 1 THEN 1 ELSE 0 END), 0) AS BIGINT) AS fp, "
       "CAST(coalesce(SUM(CASE WHEN is_denied = 1 AND predicted = 0 THEN 1 ELSE 0 END), 0) AS BIGINT) AS fn, "
       "CAST(coalesce(SUM(CASE WHEN is_denied = 1 AND predicted = 1 THEN 1 ELSE 0 END), 0) AS BIGINT) AS tp "
       "FROM pr)")


def _dv(a, b):
    return f"coalesce(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0), {D(0.0)})"


_P1, _R1 = _dv("tp", "tp + fp"), _dv("tp", "tp + fn")
_P0, _R0 = _dv("tn", "tn + fn"), _dv("tn", "tn + fp")
_F1 = _dv(f"2 * {_P1} * {_R1}", f"{_P1} + {_R1}")
_F0 = _dv(f"2 * {_P0} * {_R0}", f"{_P0} + {_R0}")
_ACC = _dv("tp + tn", "tp + tn + fp + fn")
_AUC = "SUM(pos * (neg_below + neg * 0.5)) / (CAST(any_value(P) AS DOUBLE) * CAST(any_value(N) AS DOUBLE))"
_AP = "SUM(pos * (CAST(tp AS DOUBLE) / (tp + fp))) / CAST(any_value(P) AS DOUBLE)"


@register("win_score_cumulative", S.with_(_CUM, scored=True) + "SELECT threshold, pos, neg, tp, fp, neg_below FROM cum")
def q_cumulative(spark, d):
    """Cumulative tp/fp by descending score (two-level prefix sums)."""
    cum, _, _ = M.cumulative(scored(spark, d))
    return cum


@register("metric_auc", S.with_(_CUM, scored=True) + f"SELECT {_AUC} AS auc FROM cum")
def q_auc(spark, d):
    """M1: ROC AUC of the rule score against the label."""
    return M.auc(scored(spark, d))


@register("roc_curve", S.with_(_CUM, scored=True) +
          "SELECT threshold, CAST(fp AS DOUBLE) / N AS fpr, CAST(tp AS DOUBLE) / P AS tpr FROM cum "
          "UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0")
def q_roc(spark, d):
    """M2: ROC points with the (inf, 0, 0) start."""
    return M.roc_curve(scored(spark, d))


@register("pr_curve", S.with_(_CUM, scored=True) +
          "SELECT threshold, CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END AS precision, "
          "CAST(tp AS DOUBLE) / P AS recall FROM cum UNION ALL SELECT NULL, 1.0, 0.0")
def q_pr(spark, d):
    """M3: precision-recall points with the final (recall 0, precision 1)."""
    return M.pr_curve(scored(spark, d))


@register("average_precision", S.with_(_CUM, scored=True) +
          f"SELECT {_AP} AS average_precision, CAST(any_value(P) AS DOUBLE) / (any_value(P) + any_value(N)) "
          "AS prevalence FROM cum")
def q_ap(spark, d):
    """M4: average precision and prevalence."""
    return M.average_precision(scored(spark, d))


_CAL_BIN = " + ".join(f"CASE WHEN p_denial > {D(e)} THEN 1 ELSE 0 END" for e in M.CALIBRATION_EDGES)


@register("calibration_curve", S.with_(scored=True) + f"""SELECT CAST({_CAL_BIN} AS INT) AS bin,
  AVG(p_denial) AS mean_predicted, AVG(CAST(is_denied AS DOUBLE)) AS fraction_positive, COUNT(*) AS n
FROM sc WHERE p_denial IS NOT NULL AND is_denied IS NOT NULL GROUP BY 1""")
def q_calibration(spark, d):
    """M5: 10-bin calibration table."""
    return M.calibration_curve(scored(spark, d))


def _pred(spark, d):
    return scored(spark, d).withColumn("predicted", (F.col(SC.P) >= 0.5).cast("int"))


@register("confusion_matrix", S.with_(_PRED, _CM, scored=True) + "SELECT tn, fp, fn, tp FROM cm")
def q_cm(spark, d):
    """M6: confusion matrix at threshold 0.5."""
    return M.confusion_matrix(_pred(spark, d))


@register("classification_metrics", S.with_(_PRED, _CM, scored=True) +
          f"SELECT {_P1} AS precision, {_R1} AS recall, {_F1} AS f1, {_ACC} AS accuracy FROM cm")
def q_cls_metrics(spark, d):
    """M7: precision, recall, F1, accuracy."""
    return M.classification_metrics(M.confusion_matrix(_pred(spark, d)))


@register("classification_report", S.with_(_PRED, _CM, scored=True) + f"""
SELECT '0' AS label, {_P0} AS precision, {_R0} AS recall, {_F0} AS f1_score, tn + fp AS support FROM cm
UNION ALL SELECT '1', {_P1}, {_R1}, {_F1}, tp + fn FROM cm
UNION ALL SELECT 'accuracy', NULL, NULL, {_ACC}, tn + fp + tp + fn FROM cm
UNION ALL SELECT 'macro avg', ({_P0} + {_P1}) / 2, ({_R0} + {_R1}) / 2, ({_F0} + {_F1}) / 2, tn + fp + tp + fn FROM cm
UNION ALL SELECT 'weighted avg', {_dv(f"{_P0} * (tn + fp) + {_P1} * (tp + fn)", "tn + fp + tp + fn")},
  {_dv(f"{_R0} * (tn + fp) + {_R1} * (tp + fn)", "tn + fp + tp + fn")},
  {_dv(f"{_F0} * (tn + fp) + {_F1} * (tp + fn)", "tn + fp + tp + fn")}, tn + fp + tp + fn FROM cm""")
def q_cls_report(spark, d):
    """M8: per-class report with macro / weighted averages."""
    return M.classification_report(M.confusion_matrix(_pred(spark, d)))


@register("evaluate_model", S.with_(_CUM, _PRED, _CM, scored=True) + f"""SELECT
  (SELECT {_AUC} FROM cum) AS auc, {_P1} AS precision, {_R1} AS recall, {_F1} AS f1, {_ACC} AS accuracy,
  (SELECT {_AP} FROM cum) AS average_precision FROM cm""")
def q_evaluate(spark, d):
    """M9: full evaluation record."""
    return M.evaluate(scored(spark, d))


# ------------------------------------------------------------------- drift
_SPLIT = "DATE '2000-01-01'"


def _split_mi(spark, d):
    f = FE.features_wide(claims(spark, d))
    mi = FE.model_input(f, keep=("claim_id", "service_date"))
    cut = F.lit("2000-01-01").cast("date")
    return mi.where(F.col("service_date") < cut), mi.where(F.col("service_date") >= cut)


def _drift_stack(spark, d):
    """One feature pass tagged train/score by date, written for the drift
    passes."""
    mi = FE.model_input(FE.features_wide(claims(spark, d)), keep=("claim_id", "service_date"))
    date = F.col("service_date")
    tag = F.when(date < F.lit("2000-01-01").cast("date"), "train").otherwise("score")
    return mi, cut_lineage(mi.where(date.isNotNull()).select(
        tag.alias("dataset"), *[F.col(c).cast("double").alias(c) for c in FEATURE_COLUMNS]))


def _drift(spark, d, what):
    tr, stack = _drift_stack(spark, d)
    if what == "psi":
        return DR.psi(tr, tr, FEATURE_COLUMNS, stack=stack)
    return DR.drift_features(tr, tr, FEATURE_COLUMNS, stack=stack)


_MI2 = ("mi2 AS (SELECT CASE WHEN service_date < " + _SPLIT + " THEN 'train' ELSE 'score' END AS dataset, "
        + ", ".join(f"CAST(coalesce({c}, 0) AS DOUBLE) AS {c}" for c in FEATURE_COLUMNS)
        + " FROM feat WHERE service_date IS NOT NULL)")
_LV = "lv AS (UNPIVOT mi2 ON " + ", ".join(FEATURE_COLUMNS) + " INTO NAME feature VALUE value)"
_BIN = " + ".join(f"CASE WHEN lv.value >= {D(float(i))} * ed.step + ed.lo THEN 1 ELSE 0 END" for i in range(1, 10))
_EPS_N = D(10 * DR.EPS)
_PSI_CTES = [_MI2, _LV, f"""mm AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM lv GROUP BY feature),
ed AS (SELECT feature, lo, hi, (hi - lo) / {D(10.0)} AS step FROM mm),
bn AS (SELECT lv.feature, lv.dataset, {_BIN} AS bin FROM lv JOIN ed ON lv.feature = ed.feature),
cn AS (SELECT feature, bin, SUM(CASE WHEN dataset = 'train' THEN 1 ELSE 0 END) AS e,
              SUM(CASE WHEN dataset = 'score' THEN 1 ELSE 0 END) AS a FROM bn GROUP BY feature, bin),
grid AS (SELECT feature, unnest(range(0, 10)) AS bin FROM ed),
fl AS (SELECT g.feature, g.bin, CAST(coalesce(c.e, 0) AS DOUBLE) AS e, CAST(coalesce(c.a, 0) AS DOUBLE) AS a
       FROM grid g LEFT JOIN cn c ON g.feature = c.feature AND g.bin = c.bin),
tt AS (SELECT feature, SUM(e) AS ne, SUM(a) AS na FROM fl GROUP BY feature),
pc AS (SELECT fl.feature, (fl.e + {D(DR.EPS)}) / (tt.ne + {_EPS_N}) AS ep,
              (fl.a + {D(DR.EPS)}) / (tt.na + {_EPS_N}) AS ap, tt.ne, tt.na FROM fl JOIN tt ON fl.feature = tt.feature),
ps AS (SELECT pc.feature, CAST(list_position({S.sql_list(FEATURE_COLUMNS)}, pc.feature) AS INT) AS feature_index,
         CASE WHEN any_value(ne) = 0 OR any_value(na) = 0 OR any_value(ed.lo) = any_value(ed.hi) THEN 0.0
              ELSE SUM((ap - ep) * ln(ap / ep)) END AS psi
       FROM pc JOIN ed ON pc.feature = ed.feature GROUP BY pc.feature),
st AS (SELECT feature,
         AVG(CASE WHEN dataset = 'train' THEN value END) AS training_mean,
         STDDEV_SAMP(CASE WHEN dataset = 'train' THEN value END) AS training_std,
         AVG(CASE WHEN dataset = 'score' THEN value END) AS scoring_mean,
         STDDEV_SAMP(CASE WHEN dataset = 'score' THEN value END) AS scoring_std FROM lv GROUP BY feature),
df AS (SELECT ps.feature_index, ps.feature, {S.np_round_sql('ps.psi', 6)} AS psi,
         CASE WHEN ps.psi >= 0.2 THEN 'critical' WHEN ps.psi >= 0.1 THEN 'warning' ELSE 'stable' END AS status,
         {S.np_round_sql('st.training_mean', 4)} AS training_mean, {S.np_round_sql('st.training_std', 4)} AS training_std,
         {S.np_round_sql('st.scoring_mean', 4)} AS scoring_mean, {S.np_round_sql('st.scoring_std', 4)} AS scoring_std
       FROM ps JOIN st ON ps.feature = st.feature)"""]


@register("psi", S.with_(*_PSI_CTES) + "SELECT feature_index, feature, psi FROM ps")
def q_psi(spark, d):
    """K1: PSI of every feature, train (before 2000) vs score (from 2000)."""
    return _drift(spark, d, "psi")


@register("drift_features", S.with_(*_PSI_CTES) + "SELECT * FROM df")
def q_drift_features(spark, d):
    """K2: per-feature drift status with summary statistics."""
    return _drift(spark, d, "local")


RUN_TS = "2024-01-01T02:00:00"
_REPORT_SQL = S.with_(*_PSI_CTES, """rp AS (
  SELECT COUNT(*) AS n_features_monitored,
    list(feature ORDER BY feature_index) FILTER (WHERE status = 'warning') AS w,
    list(feature ORDER BY feature_index) FILTER (WHERE status = 'critical') AS c
  FROM df)""") + f"""SELECT '{RUN_TS}' AS timestamp,
  CASE WHEN len(coalesce(c, [])) > 0 THEN 'critical' WHEN len(coalesce(w, [])) > 0 THEN 'warning' ELSE 'stable' END
    AS overall_status,
  n_features_monitored, CAST(len(coalesce(w, [])) AS INT) AS n_features_warning,
  CAST(len(coalesce(c, [])) AS INT) AS n_features_critical,
  array_to_string(coalesce(w, []), '|') AS features_with_drift, array_to_string(coalesce(c, []), '|') AS features_critical,
  CASE WHEN len(coalesce(c, [])) > 0 THEN concat({S.q(DR.REC_CRITICAL.split('{}')[0])},
       array_to_string(c[1:5], ', '), {S.q(DR.REC_CRITICAL.split('{}')[1])})
       WHEN len(coalesce(w, [])) > 0 THEN {S.q(DR.REC_WARNING)} ELSE {S.q(DR.REC_STABLE)} END AS recommendation
FROM rp"""


@register("drift_report", _REPORT_SQL)
def q_drift_report(spark, d):
    """K3: drift report row (fixed run timestamp for reproducibility)."""
    return DR.drift_report(_drift(spark, d, "local"), run_ts=RUN_TS)


@register("feature_profile", S.with_(*_PSI_CTES) + """SELECT feature, training_mean, training_std, scoring_mean,
  scoring_std FROM st""")
def q_feature_profile(spark, d):
    """Per-feature mean / sample std for train and score."""
    _, stack = _drift_stack(spark, d)
    return DR.stacked_profile(stack, FEATURE_COLUMNS)


@register("prediction_profile", S.with_(scored=True) +
          "SELECT AVG(p_denial) AS mean, STDDEV_POP(p_denial) AS std, COUNT(p_denial) AS n FROM sc")
def q_pred_profile(spark, d):
    """Mean / population std of predicted probabilities."""
    return DR.prediction_profile(scored(spark, d))


_Z = f"abs(AVG(p_denial) - {D(0.25)}) / {D(0.05)}"


@register("prediction_shift", S.with_(scored=True) + f"""SELECT {S.np_round_sql('AVG(p_denial)', 4)} AS current_denial_rate,
  {D(0.25)} AS historical_denial_rate, {S.np_round_sql(_Z, 2)} AS z_score,
  CASE WHEN {_Z} > 3 THEN 'critical' WHEN {_Z} > 2 THEN 'warning' ELSE 'stable' END AS status FROM sc""")
def q_pred_shift(spark, d):
    """K4: prediction-mean shift against the historical 25 %."""
    return DR.prediction_shift(scored(spark, d))
