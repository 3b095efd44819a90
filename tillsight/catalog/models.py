"""Fitted models: linear ones and single trees are fitted by SQL as well, the others checked by rows and properties."""

import uuid

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tillsight.catalog.derive import GAP, MOMENTUM, SHORT, SPREAD
from tillsight.catalog.explore import TIER
from tillsight.catalog.registry import PAST, query, rounded
from tillsight.catalog.views import SPEC, customer_table
from tillsight.models import estimators as e
from tillsight.models import variants as v
from tillsight.models.boosting import BinnedMatrix, Boost, Fit, fit_all
from tillsight.models.evaluate import importance_table, regression_metrics
from tillsight.models.prep import as_doubles, vector_pipeline, vector_stages
from tillsight.models.scoring import SpendPredictor
from tillsight.models.twostage import fit_two_stage, hard_decision
from tillsight.operators.splits import validation_tail
from tillsight.plans import feature_job as fj
from tillsight.plans import scoring_job
from tillsight.plans.training_job import best_of, coded_on_train, compare_models, compare_on, split_features, train_two_stage
from tillsight.session import cut_lineage, shared_folder
from tillsight.sources.schemas import PRESETS

FAMILY = "momentum32"
FEATURES = PRESETS[FAMILY]
TWO_STAGE = PRESETS["two_stage"]
Y = "future_spend_30d"


def _features(t, family=FAMILY):
    """A feature family on line totals; categories are coded on training rows only."""
    return fj.order_features(t.header, t.lines, t.customers, SPEC, family, coded=False)


def _split(t, family=FAMILY):
    return coded_on_train(*split_features(_features(t, family)), PRESETS[family])


def _one_feature(t):
    """A linear model of one feature on all rows, which SQL can fit as well."""
    rows = customer_table(t)
    return rows, SpendPredictor.fit(rows, e.linear(), ["total_monetary"], target=Y, scale=False)


def _raw_sides(t, features=None):
    """The training rows, which define the codes, and all customers with a history; of a written feature table, if there is one."""
    features = cut_lineage(_features(t)) if features is None else features
    return split_features(features)[0], features


def _predictor(t, estimator=None):
    train, test = _split(t)
    p = SpendPredictor.fit(train, estimator or e.linear(), FEATURES, target=Y, name="Linear Regression")
    row = regression_metrics(p.predict(test), Y, "prediction").first()
    p.metrics = {"test_mae": row["mae"], "test_rmse": row["rmse"], "test_r2": row["r2"]}
    return p, test


def _scores(t, estimator, log=True):
    train, test = _split(t)
    return v.fit_and_score(train, test, FEATURES, estimator, Y, log).select("customer_id", "target_capped", "prediction")


@query(
    "p_vector", "customers",
    """WITH x AS (SELECT *, avg(total_loyalty_points) OVER () AS m, stddev_samp(total_loyalty_points) OVER () AS d FROM customers),
      lo AS (SELECT list(DISTINCT loyalty_status ORDER BY loyalty_status) AS names FROM customers),
      se AS (SELECT list(DISTINCT segment_id ORDER BY segment_id) AS names FROM customers),
      v AS (SELECT customer_id, list_concat([round((total_loyalty_points - m) / d, 6)], list_concat(
              list_transform(lo.names, lambda n: CAST(n = loyalty_status AS DOUBLE)), list_transform(se.names, lambda n: CAST(n = segment_id AS DOUBLE)))) AS features
            FROM x, lo, se)
      SELECT customer_id, CAST(i AS INT) AS place, features[i + 1] AS value FROM (SELECT *, unnest(range(len(features))) AS i FROM v)""",
)
def vector(t):
    rows = t.customers.select("customer_id", "loyalty_status", "segment_id", "total_loyalty_points")
    model = vector_pipeline(["total_loyalty_points"], ["loyalty_status", "segment_id"]).fit(rows)
    cells = model.transform(rows).select("customer_id", F.posexplode(vector_to_array("features")).alias("place", "value"))
    return cells.withColumn("value", F.round("value", 6))


@query(
    "m_linear_one_feature", "cust",
    "SELECT round(regr_slope(future_spend_30d, total_monetary), 6) AS slope, round(regr_intercept(future_spend_30d, total_monetary), 4) AS intercept FROM cust",
)
def linear_one_feature(t):
    _, p = _one_feature(t)
    line = p.model.stages[-1]
    row = (round(float(line.coefficients[0]), 6), round(float(line.intercept), 4))
    return t.spark.createDataFrame([row], "slope double, intercept double")


ONE = """line AS (SELECT regr_slope(future_spend_30d, total_monetary) AS a, regr_intercept(future_spend_30d, total_monetary) AS b FROM cust),
  one AS (SELECT cust.*, greatest(a * total_monetary + b, 0) AS predicted FROM cust, line)"""


@query("m_linear_scores", "cust", f"WITH {ONE} SELECT customer_id, round(predicted, 3) AS predicted FROM one")
def linear_scores(t):
    rows, p = _one_feature(t)
    return p.predict(rows).select("customer_id", F.round("prediction", 3).alias("predicted"))


@query(
    "m_linear_metrics", "cust",
    f"""WITH {ONE} SELECT round(avg(abs(future_spend_30d - predicted)), 3) AS mae, round(sqrt(avg((future_spend_30d - predicted) ** 2)), 3) AS rmse,
          round(1 - sum((future_spend_30d - predicted) ** 2) / (count(*) * var_pop(future_spend_30d)), 4) AS r2 FROM one""",
)
def linear_metrics(t):
    rows, p = _one_feature(t)
    m = regression_metrics(p.predict(rows), Y, "prediction")
    return m.select(F.round("mae", 3).alias("mae"), F.round("rmse", 3).alias("rmse"), F.round("r2", 4).alias("r2"))


@query(
    "m_ridge_one_feature", "cust",
    """SELECT alpha, round(covar_pop(future_spend_30d, total_monetary) * count(*) / (var_pop(total_monetary) * count(*) + alpha * 1e9), 6) AS slope
       FROM cust, (SELECT unnest([0.01, 0.1, 1.0, 10.0, 100.0, 1000.0])::DOUBLE AS alpha) GROUP BY alpha""",
)
def ridge_one_feature(t):
    """Penalties on the scale of the feature's squares, so that each one moves the slope."""
    rows = cut_lineage(as_doubles(customer_table(t), ["total_monetary"]).withColumn("label", F.col(Y)))
    ready = vector_pipeline(["total_monetary"], scale=False).fit(rows).transform(rows)
    found = [(a, round(float(e.ridge(a * 1e9).fit(ready).coefficients[0]), 6)) for a in e.RIDGE_ALPHAS]
    return t.spark.createDataFrame(found, "alpha double, slope double")


@query(
    "sc_round_trip_scores", "cust",
    f"WITH {ONE} SELECT customer_id, round(predicted, 3) AS predicted FROM one ORDER BY predicted DESC, customer_id LIMIT 10",
)
def round_trip_scores(t):
    """The ten largest scores of a model that was saved and loaded."""
    rows, p = _one_feature(t)
    path = shared_folder(t.spark, f"predictor-{uuid.uuid4().hex}")
    p.save(path)
    scored = SpendPredictor.load(t.spark, path).predict(rows)
    top = scored.orderBy(F.desc("prediction"), "customer_id").limit(10)
    return top.select("customer_id", F.round("prediction", 3).alias("predicted"))


# Linear models of all features -------------------------------------------------------------

FORMULAS = {c: c for c in FEATURES} | MOMENTUM | SHORT | SPREAD | {"total_loyalty_points": "coalesce(points, 0)"}
CODED = {"loyalty_status_encoded": "lo", "segment_id_encoded": "se"}
CELLS = ", ".join(f"coalesce({CODED[c]}.code, -1)::DOUBLE" if c in CODED else f"coalesce(({FORMULAS[c]})::DOUBLE, 0)" for c in FEATURES)
WIDTH = len(FEATURES)

# Customers with their features x; the earliest 80 % are in the training rows, which define the codes.
ML = f"""f AS (SELECT p.*, loyalty_status, segment_id, c.total_loyalty_points AS points, v.num_stores_visited, {GAP} AS avg_days_between_purchases,
    row_number() OVER (ORDER BY last_purchase, md5(CAST(p.customer_id AS VARCHAR))) <= floor(0.8::DOUBLE * count(*) OVER ()) AS early
  FROM profile p LEFT JOIN customers c ON p.customer_id = c.customer_id
    JOIN (SELECT customer_id, count(DISTINCT store_id) AS num_stores_visited FROM sales WHERE {PAST} GROUP BY 1) v ON p.customer_id = v.customer_id),
  lo AS (SELECT loyalty_status, row_number() OVER (ORDER BY loyalty_status) - 1 AS code FROM (SELECT DISTINCT loyalty_status FROM f WHERE early)),
  se AS (SELECT segment_id, row_number() OVER (ORDER BY segment_id) - 1 AS code FROM (SELECT DISTINCT segment_id FROM f WHERE early)),
  ml AS (SELECT customer_id, last_purchase, early, future_spend_30d AS y, [{CELLS}] AS x
         FROM f LEFT JOIN lo USING (loyalty_status) LEFT JOIN se USING (segment_id)),
  cap AS (SELECT quantile_cont(y, 0.99) AS cap FROM ml WHERE early AND y > 0)"""

# Time slices of the training rows; fold i learns from the slices up to i and is tested on the next one.
FOLDS = """ranked AS (SELECT *, row_number() OVER (ORDER BY last_purchase, md5(CAST(customer_id AS VARCHAR))) - 1 AS r, count(*) OVER () AS n FROM ml WHERE early),
  sliced AS (SELECT *, greatest(0, 5 - ((n - 1 - r) // (n // 6))) AS slice FROM ranked),
  folds AS (SELECT unnest(range(5)) AS fold),
  caps AS (SELECT fold, quantile_cont(y, 0.99) AS cap FROM sliced, folds WHERE slice <= fold AND y > 0 GROUP BY fold)"""


def linear_sql(train: str, alphas: str = "0.0") -> str:
    """CTEs of linear models by elimination: ``train`` gives (id, customer_id, x, label); ``lin`` has, for each
    id and penalty, the weights w of the scaled features, their means and deviations, and the label's mean."""
    pivot = "m[k + 1][k + 1]"
    gone = "list_transform(m, lambda r, i: CASE WHEN i = k + 1 THEN list_transform(r, lambda v: 0.0::DOUBLE) ELSE list_transform(r, lambda v, j: CASE WHEN j = k + 1 THEN 0.0::DOUBLE ELSE v END) END)"
    step = f"list_transform(m, lambda r, i: CASE WHEN i = k + 1 THEN list_transform(r, lambda v: v / {pivot}) ELSE list_transform(r, lambda v, j: v - r[k + 1] * m[k + 1][j] / {pivot}) END)"
    return f"""tr AS ({train}),
  per AS (SELECT id, i, avg(x[i]) AS mu, stddev_samp(x[i]) AS sd FROM tr, range(1, {WIDTH + 1}) AS t(i) GROUP BY id, i),
  st AS (SELECT id, list(mu ORDER BY i) AS mu, list(CASE WHEN sd > 1e-12 * abs(mu) THEN sd ELSE 0 END ORDER BY i) AS sd FROM per GROUP BY id),
  lm AS (SELECT id, avg(label) AS ml FROM tr GROUP BY id),
  zs AS (SELECT id, customer_id, list_append(list_transform(x, lambda v, i: CASE WHEN sd[i] > 0 THEN (v - mu[i]) / sd[i] ELSE 0 END), label - ml) AS z
         FROM tr JOIN st USING (id) JOIN lm USING (id)),
  grams AS (SELECT id, i, j, sum(z[i] * z[j]) AS v FROM zs, range(1, {WIDTH + 1}) AS a(i), range(1, {WIDTH + 2}) AS b(j) GROUP BY id, i, j),
  alphas AS (SELECT unnest([{alphas}])::DOUBLE AS alpha),
  augmented AS (SELECT id, alpha, i, list(CASE WHEN i = j THEN v + alpha ELSE v END ORDER BY j) AS line FROM grams, alphas GROUP BY id, alpha, i),
  whole AS (SELECT id, alpha, list(line ORDER BY i) AS m, list(line[i] ORDER BY i) AS own FROM augmented GROUP BY id, alpha),
  el AS (SELECT id, alpha, 0 AS k, m, own FROM whole
         UNION ALL SELECT id, alpha, k + 1, CASE WHEN {pivot} > 1e-9 * own[k + 1] THEN {step} ELSE {gone} END, own FROM el WHERE k < {WIDTH}),
  lin AS (SELECT id, alpha, list_transform(m, lambda r: r[{WIDTH + 1}]) AS w, mu, sd, ml FROM el JOIN st USING (id) JOIN lm USING (id) WHERE k = {WIDTH})"""


SCORE = "ml + list_sum(list_transform(x, lambda v, i: CASE WHEN sd[i] > 0 THEN w[i] * (v - mu[i]) / sd[i] ELSE 0 END))"


# Fold i learns from the slices up to i, with the target capped by its own spenders.
FOLD_ROWS = "SELECT fold AS id, customer_id, x, ln(1 + least(y, cap)) AS label FROM sliced JOIN caps ON slice <= fold"
FOLD_ERRORS = f"""errors AS (SELECT id, alpha, avg(abs(y - greatest(exp({SCORE}) - 1, 0))) AS mae
  FROM (SELECT slice, y, x FROM sliced) s JOIN lin ON s.slice = lin.id + 1 GROUP BY id, alpha)"""
PLAIN = linear_sql("SELECT 0 AS id, customer_id, x, y AS label FROM ml WHERE early")

# Scores to one cent, their tier, and the band of the test rows' mean error.
SCORES = f"""WITH RECURSIVE {ML}, {PLAIN}, scored AS (SELECT customer_id, early, y, greatest({SCORE}, 0) AS p FROM (SELECT customer_id, early, y, x FROM ml), lin),
  mae AS (SELECT avg(abs(y - p)) AS mae FROM scored WHERE NOT early),
  details AS (SELECT customer_id, early, round_even(p, 2) AS s FROM scored)
  SELECT customer_id, round(s, 1) AS predicted_spend_30d, {TIER} AS spend_category,
    round(greatest(s - mae, 0), 1) AS prediction_range_low, round(s + mae, 1) AS prediction_range_high
  FROM details, mae WHERE {{0}} {{1}}"""


def _rounded_scores(scored):
    """Scores and bands to one digit, as engines differ in the last ones."""
    return rounded(scored, 1)


# Boosted trees ---------------------------------------------------------------------------

SPLIT_ON = ["total_frequency", "frequency_30d", "frequency_60d", "frequency_90d", "recency_months"]


def tree_sql(rows: str, rate: float, l1: float, l2: float, depth: int, out: str) -> str:
    """One boosting round in SQL. ``rows`` gives customer_id, the class k, gradient g, curvature h
    and margin m; each class grows its tree by trying every value of every feature as a cut."""
    shrunk = lambda g: f"(sign({g}) * greatest(abs({g}) - {l1}, 0))"
    score = lambda g, h: f"({shrunk(g)} ** 2 / nullif({h} + {l2}, 0) / 2)"
    values = ", ".join(f"({j}, {f}::DOUBLE)" for j, f in enumerate(SPLIT_ON))
    parts = [
        "base AS (SELECT *, recency_days // 30 AS recency_months FROM cust)",
        f"cells AS (SELECT customer_id, c.j, c.x FROM base, LATERAL (VALUES {values}) AS c(j, x))",
        f"n0 AS (SELECT *, 0 AS node FROM ({rows}))",
    ]
    for d in range(depth):
        parts += [
            f"hist{d} AS (SELECT k, node, j, x, sum(g) AS g, sum(h) AS h FROM n{d} JOIN cells USING (customer_id) GROUP BY ALL)",
            f"""cut{d} AS (SELECT k, node, j, x, sum(g) OVER below AS gl, sum(h) OVER below AS hl, sum(g) OVER whole AS g, sum(h) OVER whole AS h FROM hist{d}
                 WINDOW below AS (PARTITION BY k, node, j ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), whole AS (PARTITION BY k, node, j))""",
            f"""best{d} AS (SELECT *, {score('gl', 'hl')} + {score('(g - gl)', '(h - hl)')} - {score('g', 'h')} AS gain FROM cut{d} WHERE gl IS NOT NULL
                 QUALIFY row_number() OVER (PARTITION BY k, node ORDER BY gain DESC, j, x) = 1)""",
            f"""n{d + 1} AS (SELECT n.customer_id, n.k, n.g, n.h, n.m, CASE WHEN b.gain > 1e-9 THEN 2 * n.node + 1 + (c.x >= b.x)::INT ELSE n.node END AS node
                 FROM n{d} n LEFT JOIN best{d} b ON n.k = b.k AND n.node = b.node LEFT JOIN cells c ON c.customer_id = n.customer_id AND c.j = b.j)""",
        ]
    parts.append(f"leaves AS (SELECT k, node, -{rate} * {shrunk('sum(g)')} / (sum(h) + {l2}) AS v FROM n{depth} GROUP BY ALL)")
    parts.append(f"grown AS (SELECT customer_id, k, m + v AS m FROM n{depth} JOIN leaves USING (k, node))")
    return f"WITH {', '.join(parts)} {out}"


def _grown(t, boost, label, depth=2):
    """One round on all customers, with every value of the features as a cut."""
    rows = customer_table(t).withColumn("recency_months", F.floor(F.col("recency_days") / 30))
    matrix = BinnedMatrix.build(rows, SPLIT_ON, {"label": label})
    return fit_all(matrix, {"one": Fit(boost, "label")})["one"].transform(rows)


@query(
    "m_tree_penalised", "cust",
    tree_sql("SELECT customer_id, 0 AS k, a - future_spend_30d AS g, 1.0 AS h, a AS m FROM cust, (SELECT avg(future_spend_30d) AS a FROM cust)",
             0.5, 100000.0, 3.0, 2, "SELECT customer_id, round(m, 2) AS predicted FROM grown"),
)
def tree_penalised(t):
    """A tree whose leaves pay for their sum of gradients (L1) and for their square (L2)."""
    boost = Boost(rounds=1, depth=2, rate=0.5, l1=100000.0, l2=3.0)
    return _grown(t, boost, F.col(Y)).select("customer_id", F.round("prediction", 2).alias("predicted"))


@query(
    "m_tree_plain", "cust",
    tree_sql("SELECT customer_id, 0 AS k, a - future_spend_30d AS g, 1.0 AS h, a AS m FROM cust, (SELECT avg(future_spend_30d) AS a FROM cust)",
             1.0, 0.0, 0.0, 3, "SELECT customer_id, round(m, 2) AS predicted FROM grown"),
)
def tree_plain(t):
    """Without penalties: leaves are the means of their customers."""
    return _grown(t, Boost(rounds=1, depth=3, rate=1.0), F.col(Y)).select("customer_id", F.round("prediction", 2).alias("predicted"))


@query(
    "m_tree_logistic", "cust",
    tree_sql("SELECT customer_id, 0 AS k, p - will_purchase_30d AS g, p * (1 - p) AS h, ln(p / (1 - p)) AS m FROM cust, (SELECT avg(will_purchase_30d) AS p FROM cust)",
             0.3, 0.0, 1.0, 2, "SELECT customer_id, round(1 / (1 + exp(-m)), 6) AS probability FROM grown"),
)
def tree_logistic(t):
    found = _grown(t, Boost(rounds=1, depth=2, rate=0.3, l2=1.0, objective="logistic"), F.col("will_purchase_30d"))
    return found.select("customer_id", F.round(F.get("probability", F.lit(1)), 6).alias("probability"))


@query(
    "m_tree_buckets", "cust",
    tree_sql("""SELECT customer_id, k, p - (bucket = k)::INT AS g, p * (1 - p) AS h, ln(p) AS m
                FROM (SELECT customer_id, (future_spend_30d > 0)::INT + (future_spend_30d > 100000)::INT + (future_spend_30d > 200000)::INT AS bucket FROM cust),
                     (SELECT (future_spend_30d > 0)::INT + (future_spend_30d > 100000)::INT + (future_spend_30d > 200000)::INT AS k,
                             count(*) / (SELECT count(*) FROM cust) AS p FROM cust GROUP BY 1)""",
             0.4, 0.0, 1.0, 2, """SELECT customer_id, CAST(k AS INT) AS bucket, round(exp(m) / sum(exp(m)) OVER (PARTITION BY customer_id), 6) AS probability FROM grown"""),
)
def tree_buckets(t):
    """Softmax over four buckets of spend: one tree per bucket on the same histograms."""
    y = F.col(Y)
    bucket = sum((F.when(y > x, 1).otherwise(0) for x in (100_000, 200_000)), F.when(y > 0, 1).otherwise(0))
    found = _grown(t, Boost(rounds=1, depth=2, rate=0.4, l2=1.0, objective="softmax", classes=4), bucket)
    cells = found.select("customer_id", F.posexplode("probability").alias("bucket", "p"))
    return cells.select("customer_id", "bucket", F.round("p", 6).alias("probability"))


@query(
    "m_linear", "profile sales customers",
    f"""WITH RECURSIVE {ML}, {linear_sql("SELECT 0 AS id, customer_id, x, least(y, cap) AS label FROM ml, cap WHERE early")}
      SELECT customer_id, least(y, cap) AS target_capped, round(greatest({SCORE}, 0), 1) AS prediction FROM (SELECT * EXCLUDE (early) FROM ml, cap WHERE NOT early), lin""",
)
def linear(t):
    return _scores(t, e.linear(), log=False).withColumn("prediction", F.round("prediction", 1))


@query(
    "m_ridge", "profile sales customers",
    f"""WITH RECURSIVE {ML}, {linear_sql("SELECT 0 AS id, customer_id, x, ln(1 + least(y, cap)) AS label FROM ml, cap WHERE early", "1.0")}
      SELECT customer_id, least(y, cap) AS target_capped, round(greatest(exp({SCORE}) - 1, 0), 1) AS prediction FROM (SELECT * FROM ml, cap WHERE NOT early), lin""",
)
def ridge(t):
    return _scores(t, e.ridge(1.0)).withColumn("prediction", F.round("prediction", 1))


@query("m_forest")
def forest(t):
    return _scores(t, e.forest("forest_200x8"))


@query("m_boosted")
def boosted(t):
    return _scores(t, e.boosted("boost_300x4"))


@query("m_boosted_validation")
def boosted_validation(t):
    """Early stopping on the latest training rows."""
    train, test = _split(t)
    rows = as_doubles(cut_lineage(validation_tail(train, share=0.1)), FEATURES).withColumn("label", F.log1p(Y))
    model = Pipeline(stages=[*vector_stages(FEATURES), e.boosted("boost_500x4")]).fit(rows)
    scored = model.transform(as_doubles(test, FEATURES))
    return scored.select("customer_id", F.greatest(F.expm1("prediction"), F.lit(0.0)).alias("prediction"))


@query("m_classifier")
def classifier(t):
    train, test = _split(t)
    estimator = e.spend_classifier("classify_300x3")
    rows = as_doubles(train, FEATURES).withColumn("label", F.col("will_purchase_30d").cast("double"))
    model = Pipeline(stages=[*vector_stages(FEATURES), estimator]).fit(e.with_held_back(rows, estimator))
    scored = model.transform(as_doubles(test, FEATURES))
    return scored.select("customer_id", "will_purchase_30d", vector_to_array("probability")[1].alias("probability"))


@query("m_buckets")
def buckets(t):
    scored = v.bucket_scores(*_split(t), FEATURES)
    return scored.select("customer_id", "bucket", "predicted_bucket", "bucket_value")


@query("m_two_stage")
def two_stage(t):
    train, test = _split(t, "two_stage")
    scored = hard_decision(fit_two_stage(train, TWO_STAGE).transform(test))
    return scored.select("customer_id", "spend_probability", "expected_if_spend", "predicted_spend", "predicted_spend_hard")


@query("m_two_stage_board")
def two_stage_board(t):
    return train_two_stage(_features(t, "two_stage"), TWO_STAGE)[1]


@query("m_leaderboard")
def leaderboard(t):
    return compare_models(_features(t), FEATURES, ts="first_purchase")[1]


@query("m_segment_study")
def segment_study(t):
    train, test = _split(t)
    return v.segment_study(train, test, FEATURES)


@query(
    "v_cross_validation", "profile sales customers",
    f"""WITH RECURSIVE {ML}, {FOLDS}, {linear_sql(FOLD_ROWS)}, {FOLD_ERRORS}
      SELECT 'Linear Regression' AS model, round(avg(mae), 2) AS cv_mae_mean, round(stddev_pop(mae), 2) AS cv_mae_std FROM errors""",
)
def cross_validation(t):
    board = v.ridge_grid(_split(t)[0], FEATURES, [0.0])
    return rounded(board.select(F.lit("Linear Regression").alias("model"), "cv_mae_mean", "cv_mae_std"), 2)


@query(
    "m_ridge_grid", "profile sales customers",
    f"""WITH RECURSIVE {ML}, {FOLDS}, {linear_sql(FOLD_ROWS, ', '.join(map(str, e.RIDGE_ALPHAS)))}, {FOLD_ERRORS}
      SELECT alpha, round(avg(mae), 2) AS cv_mae_mean, round(stddev_pop(mae), 2) AS cv_mae_std FROM errors GROUP BY alpha""",
)
def ridge_grid(t):
    return rounded(v.ridge_grid(_split(t)[0], FEATURES, e.RIDGE_ALPHAS), 2)


@query("v_importance")
def importance(t):
    train, _ = _split(t)
    p = SpendPredictor.fit(train, e.forest("forest_100x10"), FEATURES, target=Y)
    return importance_table(t.spark, FEATURES, p.model.stages[-1].featureImportances.toArray())


@query("t_top_importance")
def top_importance(t):
    return importance(t).limit(5)


@query(
    "v_coefficients", "profile sales customers",
    f"""WITH RECURSIVE {ML}, {PLAIN}, names AS (SELECT {FEATURES} AS names)
      SELECT names[i] AS feature, round(w[i], 2) AS importance FROM lin, names, range(1, {WIDTH + 1}) AS t(i)""",
)
def coefficients(t):
    p, _ = _predictor(t)
    return rounded(importance_table(t.spark, FEATURES, p.model.stages[-1].coefficients.toArray()), 2)


@query(
    "sc_batch", "profile sales customers",
    SCORES.format("NOT early", ""),
)
def batch(t):
    p, test = _predictor(t)
    return _rounded_scores(scoring_job.score_all(p, test))


@query(
    "sc_single", "profile sales customers",
    SCORES.format("customer_id = 42", ""),
)
def single(t):
    p, _ = _predictor(t)
    known = coded_on_train(*_raw_sides(t), FEATURES)[1]
    return _rounded_scores(scoring_job.score_one(p, known, 42))


@query(
    "sc_top", "profile sales customers",
    SCORES.format("NOT early", "ORDER BY s DESC, customer_id LIMIT 10"),
)
def top(t):
    p, test = _predictor(t)
    return _rounded_scores(scoring_job.score_top(p, test, 10))


@query(
    "sc_sample", "profile sales customers",
    SCORES.format("NOT early", "ORDER BY md5(concat(customer_id, ':42')), customer_id LIMIT 5"),
)
def sample(t):
    p, test = _predictor(t)
    return _rounded_scores(scoring_job.score_sample(p, test, 5))


@query(
    "io_model_round_trip", "profile sales customers",
    SCORES.format("NOT early", ""),
)
def model_round_trip(t):
    p, test = _predictor(t)
    path = shared_folder(t.spark, f"predictor-{uuid.uuid4().hex}")
    p.save(path)
    return _rounded_scores(scoring_job.score_all(SpendPredictor.load(t.spark, path), test))


@query("io_best_model")
def best_model(t):
    # The written sides hold all rows of the feature table, which is not built again.
    train, test = split_features(_features(t), "first_purchase")
    models, board = compare_on(train, test, FEATURES, ts="first_purchase")
    return scoring_job.score_top(best_of(models, board), coded_on_train(*_raw_sides(t, train.unionByName(test)), FEATURES)[1], 10)


@query(
    "sc_history_filter", "profile sales customers",
    SCORES.format("TRUE", ""),
)
def history_filter(t):
    """Scores of all customers known at the cutoff."""
    p, _ = _predictor(t)
    return _rounded_scores(scoring_job.score_all(p, coded_on_train(*_raw_sides(t), FEATURES)[1]))
