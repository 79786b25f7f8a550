"""Evaluation of predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from verbatide.operators import metrics as M
from workload import sql as S
from workload.tables import Query, predictions


def _rounded(df, *names):
    return df.select(*[F.round(c, 6).alias(c) if c in names else F.col(c) for c in df.columns])


def _curve(spark, d):
    return M.threshold_table(predictions(spark, d), "score", F.col("label") == 2.0)


def _legacy(spark, d):
    return M.threshold_table(predictions(spark, d), "prediction", F.col("label") > 0.5)


def accuracy(spark, d):
    return _rounded(M.accuracy(predictions(spark, d)), "accuracy")


def confusion_matrix(spark, d):
    return M.confusion_matrix(predictions(spark, d), [0.0, 1.0, 2.0])


def per_class(spark, d):
    return _rounded(M.per_class(predictions(spark, d)), "precision", "recall", "fpr", "f1")


def threshold_metrics(table):
    return lambda spark, d: _rounded(
        M.threshold_metrics(table(spark, d)), "precision", "recall", "fpr", "f_beta_1_0", "f_beta_0_5"
    )


CLASSES = f"""{S.PREDICTIONS},
rates AS (
  SELECT c.class,
         count(*) FILTER (WHERE label = c.class) AS support,
         count(*) FILTER (WHERE prediction = c.class) AS predicted,
         count(*) FILTER (WHERE label = c.class AND prediction = c.class) AS tp,
         count(*) AS n
  FROM predictions, (SELECT DISTINCT label AS class FROM predictions) c GROUP BY c.class),
scores AS (
  SELECT class, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS p, tp / support AS r,
         (predicted - tp) / (n - support) AS fpr, support, tp FROM rates),
full_scores AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM scores)"""


def _points(score: str, positive: str) -> str:
    return f"""{S.PREDICTIONS},
points AS (
  SELECT {score} AS threshold, count(*) FILTER (WHERE {positive}) AS own_tp,
         count(*) FILTER (WHERE NOT ({positive})) AS own_fp
  FROM predictions GROUP BY {score}),
curve AS (
  SELECT threshold, sum(own_tp) OVER w AS tp, sum(own_fp) OVER w AS fp,
         sum(own_tp) OVER () AS pos, sum(own_fp) OVER () AS neg
  FROM points WINDOW w AS (ORDER BY threshold DESC)),
rates AS (SELECT threshold, tp / (tp + fp) AS p, tp / pos AS r, fp / neg AS fpr FROM curve)"""


def _metrics_sql(score, positive):
    return f"""WITH {_points(score, positive)}
SELECT threshold, round(p, 6) AS precision, round(r, 6) AS recall, round(fpr, 6) AS fpr,
       round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f_beta_1_0,
       round(CASE WHEN p + r > 0 THEN 1.25 * p * r / (0.25 * p + r) ELSE 0 END, 6) AS f_beta_0_5
FROM rates"""


def _areas_sql(score, positive):
    return f"""WITH {_points(score, positive)},
steps AS (
  SELECT p, r, fpr, lag(p) OVER w AS p0, coalesce(lag(r) OVER w, 0) AS r0, coalesce(lag(fpr) OVER w, 0) AS fpr0
  FROM rates WINDOW w AS (ORDER BY threshold DESC))
SELECT round(sum((fpr - fpr0) * (r + r0) / 2), 6) AS area_under_roc,
       round(sum((r - r0) * (p + coalesce(p0, p)) / 2), 6) AS area_under_pr FROM steps"""


SCORE, CLASS_SCORE = ("score", "label = 2.0"), ("prediction", "label > 0.5")

QUERIES = {
    "accuracy": Query(
        accuracy,
        f"""WITH {S.PREDICTIONS} SELECT round(avg(CASE WHEN prediction = label THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy
            FROM predictions""",
    ),
    "confusion_matrix": Query(
        confusion_matrix,
        f"""WITH {S.PREDICTIONS}
            SELECT label, count(*) FILTER (WHERE prediction = 0) AS "predicted_0.0",
                   count(*) FILTER (WHERE prediction = 1) AS "predicted_1.0",
                   count(*) FILTER (WHERE prediction = 2) AS "predicted_2.0" FROM predictions GROUP BY label""",
    ),
    "per_label_metrics": Query(
        per_class,
        f"""WITH {CLASSES} SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(fpr, 6) AS fpr,
            support, round(f, 6) AS f1 FROM full_scores""",
    ),
    "classification_report": Query(
        lambda spark, d: M.classification_report(predictions(spark, d)),
        f"""WITH {CLASSES}
            SELECT class::VARCHAR AS class, round(p, 4) AS precision, round(r, 4) AS recall, round(f, 4) AS f1, support
            FROM full_scores
            UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 4), sum(support)::BIGINT FROM full_scores
            UNION ALL SELECT 'macro avg', round(avg(p), 4), round(avg(r), 4), round(avg(f), 4), sum(support)::BIGINT
            FROM full_scores
            UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 4),
                   round(sum(r * support) / sum(support), 4), round(sum(f * support) / sum(support), 4),
                   sum(support)::BIGINT FROM full_scores""",
    ),
    "threshold_metrics": Query(threshold_metrics(_curve), _metrics_sql(*SCORE)),
    "threshold_metrics_by_class": Query(threshold_metrics(_legacy), _metrics_sql(*CLASS_SCORE)),
    "thresholds": Query(
        lambda spark, d: M.thresholds(_curve(spark, d)),
        f"WITH {S.PREDICTIONS} SELECT DISTINCT score AS threshold FROM predictions",
    ),
    "roc_curve": Query(
        lambda spark, d: _rounded(M.roc_curve(_curve(spark, d)), "fpr", "tpr"),
        f"""WITH {_points(*SCORE)} SELECT round(fpr, 6) AS fpr, round(r, 6) AS tpr FROM rates
            UNION ALL SELECT 0.0, 0.0 UNION ALL SELECT 1.0, 1.0""",
    ),
    "pr_curve": Query(
        lambda spark, d: _rounded(M.pr_curve(_curve(spark, d)), "recall", "precision"),
        f"""WITH {_points(*SCORE)} SELECT round(r, 6) AS recall, round(p, 6) AS precision FROM rates
            UNION ALL (SELECT 0.0, round(p, 6) FROM rates ORDER BY threshold DESC LIMIT 1)""",
    ),
    "areas": Query(
        lambda spark, d: _rounded(M.areas(_curve(spark, d)), "area_under_roc", "area_under_pr"), _areas_sql(*SCORE)
    ),
    "areas_by_class": Query(
        lambda spark, d: _rounded(M.areas(_legacy(spark, d)), "area_under_roc", "area_under_pr"),
        _areas_sql(*CLASS_SCORE),
    ),
}
