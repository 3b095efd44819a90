"""Baselines and metrics on a stand-in score that both engines compute."""

from pyspark.sql import functions as F

from tillsight.catalog.registry import query, rounded
from tillsight.catalog.views import customer_table, scored
from tillsight.models import evaluate as ev
from tillsight.models.baselines import BASELINES, with_baselines
from tillsight.models.twostage import hard_decision, soft_decision
from tillsight.operators import bins as b
from tillsight.operators.splits import temporal_split
from tillsight.plans.training_job import split_features

Y = "future_spend_30d"


def _metrics(y, p, by=""):
    return f"""{by}round(avg(abs({y} - {p})), 4) AS mae, round(sqrt(avg(({y} - {p}) * ({y} - {p}))), 4) AS rmse,
      round(1 - sum(({y} - {p}) * ({y} - {p})) / nullif(count(*) * var_pop({y}), 0), 4) AS r2"""


BASE = """WITH c AS (SELECT quantile_cont(future_spend_30d, 0.99) AS cap FROM split WHERE split = 'train' AND future_spend_30d > 0),
  k AS (SELECT avg(least(future_spend_30d, cap)) AS m, avg(CAST(future_spend_30d > 0 AS INT)) AS rate,
          avg(least(future_spend_30d, cap)) FILTER (WHERE future_spend_30d > 0) AS sm, avg(ln(1 + least(future_spend_30d, cap))) AS lm
        FROM split, c WHERE split = 'train'),
  b AS (SELECT customer_id, least(future_spend_30d, cap) AS target_capped, 0.0::DOUBLE AS pred_zero, m AS pred_mean, rate * sm AS pred_conditional,
          exp(lm) - 1 AS pred_log_mean FROM split, c, k WHERE split = 'test')
"""


def _baselines(t):
    train, test = split_features(customer_table(t))
    return with_baselines(train, test)


@query(
    "m_baselines", "split",
    BASE + "SELECT customer_id, round(target_capped, 4) AS target_capped, pred_zero, round(pred_mean, 4) AS pred_mean, round(pred_conditional, 4) AS pred_conditional, round(pred_log_mean, 4) AS pred_log_mean FROM b",
)
def baselines(t):
    return rounded(_baselines(t).select("customer_id", "target_capped", *BASELINES.values()))


@query(
    "m_baseline_board", "split",
    BASE + " UNION ALL ".join(f"SELECT '{n}' AS model, {_metrics('target_capped', c)} FROM b" for n, c in BASELINES.items()),
)
def baseline_board(t):
    return rounded(ev.evaluate_models(_baselines(t), "target_capped", BASELINES))


@query(
    "v_improvement", "split",
    BASE + ", m AS (" + " UNION ALL ".join(f"SELECT '{n}' AS model, avg(abs(target_capped - {c})) AS mae, 1 - sum((target_capped - {c}) * (target_capped - {c})) / (count(*) * var_pop(target_capped)) AS r2 FROM b" for n, c in BASELINES.items()) + ")"
    + """ SELECT model, round(mae, 4) AS mae, round(((SELECT mae FROM m WHERE model = 'Mean') - mae) * 100 / (SELECT mae FROM m WHERE model = 'Mean'), 4) AS mae_improvement_pct,
          round(r2 - (SELECT r2 FROM m WHERE model = 'Mean'), 4) AS r2_gain FROM m""",
)
def improvement(t):
    board = ev.improvements(ev.evaluate_models(_baselines(t), "target_capped", BASELINES), "Mean")
    return rounded(board.select("model", "mae", "mae_improvement_pct", "r2_gain"))


@query("t_best_model", "split", BASE + ", m AS (" + " UNION ALL ".join(f"SELECT '{n}' AS model, round(avg(abs(target_capped - {c})), 4) AS mae FROM b" for n, c in BASELINES.items()) + ") SELECT * FROM m ORDER BY mae, model LIMIT 1")
def best_model(t):
    board = ev.evaluate_models(_baselines(t), "target_capped", BASELINES)
    return rounded(ev.best_model(board).select("model", "mae"))


@query("v_regression", "scored", f"SELECT {_metrics(Y, 'predicted')} FROM scored")
def regression(t):
    return rounded(ev.regression_metrics(scored(t), Y, "predicted"))


@query("v_regression_by_year", "scored", f"SELECT {_metrics(Y, 'predicted', 'CAST(year(last_purchase) AS INT) AS last_year, ')} FROM scored GROUP BY year(last_purchase)")
def regression_by_year(t):
    rows = scored(t).withColumn("last_year", F.year("last_purchase"))
    return rounded(ev.regression_metrics(rows, Y, "predicted", ["last_year"]))


CONF = """SELECT count(*) FILTER (WHERE y AND p) AS tp, count(*) FILTER (WHERE NOT y AND p) AS fp,
  count(*) FILTER (WHERE y AND NOT p) AS fn, count(*) FILTER (WHERE NOT y AND NOT p) AS tn FROM (SELECT will_purchase_30d > 0 AS y, probability >= 0.5 AS p FROM scored)"""


@query(
    "v_confusion", "scored",
    f"""SELECT tp, fp, fn, tn, round((tp + tn)::DOUBLE / (tp + fp + fn + tn), 4) AS accuracy, round(coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0), 4) AS precision,
          round(coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0), 4) AS recall, round(coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0), 4)::DOUBLE AS f1 FROM ({CONF})""",
)
def confusion(t):
    rows = scored(t).withColumn("decision", (F.col("probability") >= 0.5).cast("int"))
    return rounded(ev.classification_metrics(rows, "will_purchase_30d", "decision"))


@query(
    "v_auc", "scored",
    """WITH s AS (SELECT probability AS p, sum(CAST(will_purchase_30d > 0 AS INT)) AS pos, sum(CAST(will_purchase_30d = 0 AS INT)) AS neg FROM scored GROUP BY 1),
         c AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s)
       SELECT round(sum(pos * (below + neg / 2.0))::DOUBLE / (sum(pos) * sum(neg)), 4) AS roc_auc FROM c""",
)
def auc(t):
    return rounded(ev.roc_auc(scored(t), "will_purchase_30d", "probability"))


@query(
    "v_auc_amount", "scored",
    """WITH s AS (SELECT amount AS p, sum(CAST(will_purchase_30d > 0 AS INT)) AS pos, sum(CAST(will_purchase_30d = 0 AS INT)) AS neg FROM scored GROUP BY 1),
         c AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s)
       SELECT round(sum(pos * (below + neg / 2.0))::DOUBLE / (sum(pos) * sum(neg)), 4) AS roc_auc FROM c""",
)
def auc_amount(t):
    return rounded(ev.roc_auc(scored(t), "will_purchase_30d", "amount"))


@query(
    "v_logloss", "scored",
    """SELECT round(-avg(y * ln(p) + (1 - y) * ln(1 - p)), 4) AS log_loss FROM (SELECT will_purchase_30d::DOUBLE AS y,
         least(greatest(probability::DOUBLE, 1e-15), 1 - 1e-15::DOUBLE) AS p FROM scored)""",
)
def logloss(t):
    return rounded(ev.log_loss(scored(t), "will_purchase_30d", "probability"))


@query(
    "m_threshold_grid", "scored",
    "WITH t AS (SELECT round(0.05 * i, 2)::DOUBLE AS threshold FROM range(1, 19) r(i)) "
    f"SELECT threshold, round(avg(abs({Y} - h)), 4) AS mae, round(1 - sum(({Y} - h) * ({Y} - h)) / (count(*) * var_pop({Y})), 4) AS r2 "
    f"FROM (SELECT threshold, {Y}, CASE WHEN probability >= threshold THEN amount ELSE 0 END AS h FROM scored, t) GROUP BY 1",
)
def threshold_grid(t):
    return rounded(ev.threshold_grid(scored(t), Y, "probability", "amount"))


@query("m_soft_hard", "scored", "SELECT customer_id, probability * amount AS predicted_spend, CASE WHEN probability >= 0.5 THEN amount ELSE 0 END AS predicted_spend_hard FROM scored")
def soft_hard(t):
    rows = scored(t).withColumnsRenamed({"probability": "spend_probability", "amount": "expected_if_spend"})
    out = hard_decision(soft_decision(rows, "spend_probability", "expected_if_spend"))
    return out.select("customer_id", "predicted_spend", "predicted_spend_hard")


@query(
    "v_fit_quality", "split",
    """WITH s AS (SELECT split, sqrt(avg((future_spend_30d - monetary_90d / 3) * (future_spend_30d - monetary_90d / 3))) AS rmse FROM split GROUP BY 1),
         r AS (SELECT (SELECT rmse FROM s WHERE split = 'train') / (SELECT rmse FROM s WHERE split = 'test') AS q)
       SELECT round(q, 4) AS rmse_ratio, CASE WHEN q < 0.8 THEN 'overfitting' WHEN q > 1.2 THEN 'underfitting' ELSE 'balanced' END AS fit_quality FROM r""",
)
def fit_quality(t):
    split = temporal_split(customer_table(t)).withColumn("predicted", F.col("monetary_90d") / 3)
    by = ev.regression_metrics(split, Y, "predicted", ["split"])
    pick = lambda s: F.max(F.when(F.col("split") == s, F.col("rmse"))).alias(s)
    return rounded(by.agg(pick("train"), pick("test")).select(*[c.alias(n) for n, c in ev.fit_quality("train", "test").items()]))


@query("v_residuals", "scored", f"SELECT customer_id, round({Y} - predicted, 4) AS residual FROM scored")
def residuals(t):
    return rounded(ev.residuals(scored(t), Y, "predicted").select("customer_id", "residual"))


@query(
    "v_residual_hist", "scored",
    f"""WITH v AS (SELECT {Y} - predicted AS x FROM scored), e AS (SELECT min(x) AS lo, (max(x) - min(x)) / 30 AS w FROM v)
        SELECT CAST(least(floor((x - lo) / w), 29) AS INT) AS bin, count(*) AS rows FROM v, e GROUP BY 1""",
)
def residual_hist(t):
    return b.histogram(ev.residuals(scored(t), Y, "predicted"), "residual", 30).select("bin", "rows")
