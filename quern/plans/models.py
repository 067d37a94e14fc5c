"""Queries that fit models; results depend on floating-point order, so rows are checked by tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions.vectors import fold_by_block, fold_by_period, rescale_series
from quern.operators import features as C, logistic as L, pca as P, recommend as R, regression as G, sampling as S
from quern.plans.catalog import query
from quern.plans.data import EVENT_POINTS_SQL, POINTS_SQL, event_points, points, r, ratings, titles, vectors
from quern.plans.features import BUCKETS, HASHED_SQL, WEIGHTS, split_sql
from quern.session import stable


def _split_points(t):
    return S.random_split(points(t), "l_orderkey", WEIGHTS, 42)


def _split_ratings(t):
    keyed = ratings(t).withColumn("pair", F.concat_ws("-", "user", "item"))
    return [p.drop("pair") for p in S.random_split(keyed, "pair", [6.0, 2.0, 2.0], 42)]


def _model_rows(t, model):
    rows = [(i, float(w)) for i, w in enumerate([*model.weights, model.intercept])]
    return t.spark.createDataFrame(rows, "pos int, weight double")


# Squared error needs only sums of products, so a recursive query can repeat the steps of a fit.

PLAIN = ["f0", "f1", "f2", "f3"]
INTERACTIONS = PLAIN + [f"{a} * {b}" for a in PLAIN for b in PLAIN]


def moments_sql(name: str, part: int, features: list[str]) -> str:
    """A common table of one row: ``n``, products ``s`` and ``y`` of the features with each other and the label, ``yy``."""
    products = ", ".join("[" + ", ".join(f"sum({a} * {b})" for b in features) + "]" for a in features)
    labels = ", ".join(f"sum({a} * label)" for a in features)
    source = split_sql("l_orderkey", f"({POINTS_SQL})")
    return f"""{name} AS (SELECT count(*) AS n, [{products}] AS s, [{labels}] AS y, sum(label * label) AS yy
        FROM ({source}) WHERE split = {part})"""


RMSE_SQL = """sqrt(greatest((list_dot_product(w, list_transform(s, lambda r: list_dot_product(r, w)))
    - 2 * list_dot_product(w, y) + yy) / n, 0))"""


def sgd_sql(features: list[str], settings: list[tuple[str, int, float, float]]) -> str:
    """Common tables ``m`` (moments of the training part) and ``fit``: ``setting, w`` after all steps."""
    d = len(features)
    rows = ", ".join(f"('{name}', {n}, {step!r}::DOUBLE, {reg!r}::DOUBLE)" for name, n, step, reg in settings)
    start = "[" + ", ".join(["0"] * (d - 1) + ["1"]) + "]::DOUBLE[]"
    step = """list_transform(range(1, %d), lambda k: w[k] * (1 - step / sqrt(i + 1) * reg)
        - step / sqrt(i + 1) * (list_dot_product(s[k], w) - y[k]) / n)""" % (d + 1)
    return f"""{moments_sql("m", 0, features)},
    it AS (SELECT *, 0 AS i, {start} AS w FROM (VALUES {rows}) v(setting, iterations, step, reg)
           UNION ALL SELECT setting, iterations, step, reg, i + 1, {step} FROM it, m WHERE i < iterations),
    fit AS (SELECT setting, w FROM it WHERE i = iterations)"""


ONE = "1.0::DOUBLE"


@query(f"""
WITH RECURSIVE {moments_sql("m", 0, PLAIN)},
it AS (SELECT 0 AS i, [0, 0, 0, 0]::DOUBLE[] AS w UNION ALL
       SELECT i + 1, list_transform(range(1, 5), lambda k: w[k] - (list_dot_product(s[k], w) - y[k]) / (n * sqrt(i + 1)))
       FROM it, m WHERE i < 49)
SELECT i AS iteration, round({RMSE_SQL}, 6) AS rmse FROM it, m
""")
def linreg_gd(t):
    model = G.linreg_gd(_split_points(t)[0], 50)
    rows = [(i, float(e)) for i, e in enumerate(model.errors)]
    return t.spark.createDataFrame(rows, "iteration int, rmse double").withColumn("rmse", r("rmse", 6))


@query(f"""
WITH RECURSIVE {sgd_sql([*PLAIN, ONE], [("a", 500, 1.0, 0.1)])}
SELECT (generate_subscripts(w, 1) - 1)::INT AS pos, round(unnest(w), 6) + 0.0 AS weight FROM fit
""")
def linreg_sgd(t):
    rows = _model_rows(t, G.linreg_sgd(_split_points(t)[0], iterations=500, step=1.0, reg=0.1))
    return rows.withColumn("weight", r("weight", 6))


REGS = [{"iterations": 500, "step": 1.0, "reg": g} for g in (1e-10, 1e-5, 1.0)]
STEPS = [{"iterations": n, "step": a, "reg": 1e-10} for a in (1e-5, 10.0) for n in (500, 5)]


def _setting(s: dict) -> str:
    return ", ".join(f"{k}={v:g}" for k, v in s.items())


@query(f"""
WITH RECURSIVE {sgd_sql([*PLAIN, ONE], [(_setting(s), s["iterations"], s["step"], s["reg"]) for s in REGS + STEPS])},
{moments_sql("v", 1, [*PLAIN, ONE])},
e AS (SELECT setting, {RMSE_SQL} AS rmse FROM fit, v)
SELECT setting, CASE WHEN rmse < 1e6 THEN round(rmse, 5) END AS rmse FROM e
""")
def grid_search(t):
    """Settings whose steps run away have no error."""
    train, validation, _ = _split_points(t)
    tried = G.grid_search(train, validation, REGS + STEPS)[1]
    return tried.withColumn("rmse", F.when(F.col("rmse") < 1e6, r("rmse", 5)))


@query(f"""
WITH RECURSIVE {sgd_sql([*INTERACTIONS, ONE], [("a", 500, 1.0, 1e-10)])},
{moments_sql("v", 1, [*INTERACTIONS, ONE])}, {moments_sql("t", 2, [*INTERACTIONS, ONE])}
SELECT 'validation' AS part, round({RMSE_SQL}, 5) AS rmse FROM fit, v UNION ALL
SELECT 'test', round({RMSE_SQL}, 5) FROM fit, t
""")
def linreg_interactions(t):
    train, validation, test = _split_points(t)
    parts = {"validation": validation, "test": test}
    found = G.linreg_interactions(train, parts, iterations=500, step=1.0, reg=1e-10)[1]
    return found.withColumn("rmse", r("rmse", 5))


def _hashed_points(t):
    hashed = event_points(t).select(
        "event_id", "label", F.array_sort(F.map_entries(C.hash_features(F.col("features"), BUCKETS))).alias("e")
    )
    return hashed.select("event_id", "label", F.col("e.key").alias("idx"), F.col("e.value").alias("val"))


def logistic_sql(pairs: str, iterations: int, step: float, reg: float) -> str:
    """Common tables of a fit on the training part of the events: ``f`` numbers the features ``name``, ``fit`` has ``w``.

    ``pairs`` has ``event_id, name, x``. A step sums over all pairs again; the intercept is the last feature.
    """
    return f"""l AS (SELECT event_id, (event_type = 'error')::INT AS y, split FROM ({split_sql("event_id", "events")})),
    a AS MATERIALIZED ({pairs}),
    h AS (SELECT a.*, y FROM a JOIN l USING (event_id) WHERE split = 0),
    f AS (SELECT name, row_number() OVER (ORDER BY name) AS k FROM (SELECT DISTINCT name FROM h)),
    size AS (SELECT count(*) AS d FROM f),
    e AS MATERIALIZED (SELECT event_id, y, k, x FROM h JOIN f USING (name) UNION ALL SELECT event_id, y, d + 1, 1.0 FROM l, size WHERE split = 0),
    it AS (SELECT 0 AS i, list_transform(range(1, d + 2), lambda k: CASE WHEN k = d + 1 THEN 1.0 ELSE 0.0 END)::DOUBLE[] AS w FROM size UNION ALL
      SELECT i + 1, list(wk * (1 - r * {reg!r}::DOUBLE) - r * g / n ORDER BY k)
      FROM (SELECT i, k, any_value(wk) AS wk, sum(res * x) AS g, {step!r}::DOUBLE / sqrt(i + 1) AS r
            FROM (SELECT i, k, x, wk, 1 / (1 + exp(-(sum(wk * x) OVER (PARTITION BY event_id)))) - y AS res
                  FROM (SELECT it.i, e.event_id, e.y, e.k, e.x, it.w[e.k] AS wk FROM it, e WHERE it.i < {iterations}))
            GROUP BY i, k), (SELECT count(*) AS n FROM l WHERE split = 0)
      GROUP BY i),
    fit AS (SELECT w, d FROM it, size WHERE i = {iterations})"""


@query(f"""
WITH RECURSIVE {logistic_sql(f"SELECT event_id, bucket AS name, n AS x FROM ({HASHED_SQL})", 50, 10.0, 1e-6)}
SELECT g.pos::INT AS pos, round(coalesce(w[k], 0), 6) + 0.0 AS weight FROM range({BUCKETS}) g(pos) LEFT JOIN f ON f.name = g.pos, fit UNION ALL
SELECT {BUCKETS}, round(w[d + 1], 6) FROM fit
""")
def logreg_sgd(t):
    train = S.random_split(_hashed_points(t), "event_id", WEIGHTS, 42)[0]
    model = L.logreg_sgd(train, BUCKETS, iterations=50, step=10.0, reg=1e-6)
    seen = model.table.select(
        F.when(F.col("idx") == L.INTERCEPT, BUCKETS).otherwise(F.col("idx")).alias("pos"), r("w", 6).alias("weight")
    )
    every = t.spark.range(BUCKETS + 1).select(F.col("id").alias("pos"))
    return every.join(seen, "pos", "left").select(F.col("pos").cast("int").alias("pos"), F.coalesce("weight", F.lit(0.0)).alias("weight"))


RETURNED_SQL = """SELECT (l_returnflag = 'R')::INT AS y, l_quantity / 50 AS a, l_discount * 10 AS b, l_tax * 10 AS c FROM lineitem"""


# Every step sums the gradient over all rows again.
@query(f"""
WITH RECURSIVE p AS ({RETURNED_SQL}),
it AS (SELECT 0 AS i, 0.0::DOUBLE AS wa, 0.0::DOUBLE AS wb, 0.0::DOUBLE AS wc, 1.0::DOUBLE AS w UNION ALL
       SELECT i + 1, wa - r * (ga / n + 0.01::DOUBLE * wa), wb - r * (gb / n + 0.01::DOUBLE * wb),
              wc - r * (gc / n + 0.01::DOUBLE * wc), w - r * (g / n + 0.01::DOUBLE * w)
       FROM (SELECT i, wa, wb, wc, w, 2.0::DOUBLE / sqrt(i + 1) AS r, count(*) AS n, sum(e) AS g, sum(e * a) AS ga, sum(e * b) AS gb, sum(e * c) AS gc
             FROM (SELECT it.*, a, b, c, 1 / (1 + exp(-(wa * a + wb * b + wc * c + w))) - y AS e FROM it, p WHERE i < 12)
             GROUP BY i, wa, wb, wc, w)),
f AS (SELECT * FROM it WHERE i = 12)
SELECT 0 AS pos, round(wa, 7) AS weight FROM f UNION ALL SELECT 1, round(wb, 7) FROM f UNION ALL
SELECT 2, round(wc, 7) FROM f UNION ALL SELECT -1, round(w, 7) FROM f
""")
def logreg_numeric(t):
    values = F.array(F.col("l_quantity") / 50, F.col("l_discount") * 10, F.col("l_tax") * 10)
    rows = t.lineitem.select(
        (F.col("l_returnflag") == "R").cast("double").alias("label"), F.array(*map(F.lit, range(3))).alias("idx"), values.alias("val")
    )
    model = L.logreg_sgd(rows, 3, iterations=12, step=2.0, reg=0.01)
    return model.table.select(F.col("idx").cast("int").alias("pos"), r("w", 7).alias("weight"))


# A tenth of the rows, drawn anew by each of 30 steps.
@query(f"""
WITH RECURSIVE d AS (SELECT i, f0, f1, f2, f3, label FROM ({POINTS_SQL}), range(1, 31) g(i)
                     WHERE substr(md5(l_orderkey || ':' || (42 + i)), 1, 8) < '1999999a'),
z AS (SELECT i, count(*) AS n, [sum(x[1]), sum(x[2]), sum(x[3]), sum(x[4]), sum(x[5])] AS y, {
    "[" + ", ".join("[" + ", ".join(f"sum(z[{a}] * z[{b}])" for b in range(1, 6)) + "]" for a in range(1, 6)) + "]"
} AS s
      FROM (SELECT i, z, list_transform(z, lambda v: v * label) AS x FROM (SELECT i, label, [f0, f1, f2, f3, {ONE}] AS z FROM d)) GROUP BY i),
it AS (SELECT 0 AS i, [0, 0, 0, 0, 1]::DOUBLE[] AS w UNION ALL
       SELECT it.i + 1, list_transform(range(1, 6), lambda k: w[k] - (list_dot_product(s[k], w) - y[k]) / (n * sqrt(z.i)))
       FROM it JOIN z ON z.i = it.i + 1)
SELECT (generate_subscripts(w, 1) - 1)::INT AS pos, round(unnest(w), 6) + 0.0 AS weight FROM it WHERE i = 30
""")
def linreg_mini_batches(t):
    model = G.linreg_sgd(points(t), iterations=30, step=1.0, fraction=0.1, key="l_orderkey", seed=42)
    return _model_rows(t, model).withColumn("weight", r("weight", 6))


# Factors of parts that a fit could have left: the size, the price and a constant.
@query("""
WITH f AS (SELECT p_partkey AS item, p_size / 50.0::DOUBLE AS a, p_retailprice / 2000.0::DOUBLE AS b FROM part),
x AS (SELECT l_suppkey AS "user", a, b, 1 + l_quantity % 5 AS y FROM lineitem JOIN f ON l_partkey = item),
m AS (SELECT "user", count(*) * 1.1::DOUBLE AS n, count(*) * 0.1::DOUBLE AS q, sum(a) AS sa, sum(b) AS sb, sum(a * a) AS aa,
             sum(a * b) AS ab, sum(b * b) AS bb, sum(a * y) AS ya, sum(b * y) AS yb, sum(y) AS yy FROM x GROUP BY 1),
k AS (SELECT "user", aa + q AS p, ab AS c, bb + q AS d, sa AS e, sb AS g, n AS h, ya, yb, yy FROM m),
z AS (SELECT *, p * (d * h - g * g) - c * (c * h - g * e) + e * (c * g - d * e) AS det FROM k)
SELECT "user", round((ya * (d * h - g * g) - c * (yb * h - g * yy) + e * (yb * g - d * yy)) / det, 6) AS u0,
       round((p * (yb * h - g * yy) - ya * (c * h - g * e) + e * (c * yy - yb * e)) / det, 6) AS u1,
       round((p * (d * yy - yb * g) - c * (c * yy - yb * e) + ya * (c * g - d * e)) / det, 6) AS u2
FROM z
""")
def fold_in(t):
    """Factors of every supplier against given factors of parts, a row for each rating."""
    factors = t.part.select(
        F.col("p_partkey").alias("item"), F.array(F.col("p_size") / 50, F.col("p_retailprice") / 2000, F.lit(1.0)).alias("features")
    )
    rated = t.lineitem.select(F.col("l_suppkey").alias("user"), F.col("l_partkey").alias("item"), (1 + F.col("l_quantity") % 5).alias("rating"))
    found = R.fold_in(stable(factors), rated, 0.1)
    return found.select("user", *[r(F.col("features")[i], 6).alias(f"u{i}") for i in range(3)])


@query(f"""
WITH RECURSIVE {logistic_sql(f"SELECT event_id, feature || ' ' || value AS name, 1.0 AS x FROM ({EVENT_POINTS_SQL})", 50, 10.0, 1e-6)},
o AS (SELECT l.event_id, any_value(l.split) AS split, any_value(l.y) AS y, 1 / (1 + exp(-(sum(coalesce(w[k] * x, 0)) + any_value(w[d + 1])))) AS p
      FROM fit, l LEFT JOIN a ON a.event_id = l.event_id LEFT JOIN f ON f.name = a.name GROUP BY l.event_id),
b AS (SELECT event_id, split, y, (SELECT avg(y) FROM l WHERE split = 0) AS p FROM l),
s AS (SELECT 'one-hot' AS model, * FROM o UNION ALL SELECT 'constant', event_id, split, y, p FROM b)
SELECT model, CASE split WHEN 0 THEN 'train' ELSE 'validation' END AS part, round(avg(CASE WHEN y = 1 THEN -ln(p) ELSE -ln(1 - p) END), 7) AS log_loss
FROM s WHERE split < 2 GROUP BY model, split
""")
def logreg_log_loss(t):
    """One-hot model against the constant rate, on training and validation points."""
    p = event_points(t)
    dictionary = stable(C.one_hot_dict(p))
    encoded = stable(C.one_hot_encode(p, dictionary, "event_id"))
    train, validation, _ = S.random_split(encoded, "event_id", WEIGHTS, 42)
    model = L.logreg_sgd(train, dictionary.count(), iterations=50, step=10.0, reg=1e-6)
    weights = model.weight_table(t.spark)
    scored = [
        L.evaluate_log_loss(C.predict_proba(part, weights, model.intercept, "event_id")).withColumn("part", F.lit(name))
        for name, part in (("train", train), ("validation", validation))
    ]
    base = L.log_loss_baseline(train, {"train": train, "validation": validation}, "label")
    fitted = scored[0].unionByName(scored[1]).withColumn("model", F.lit("one-hot"))
    return fitted.unionByName(base.withColumn("model", F.lit("constant"))).withColumn("log_loss", r("log_loss", 7))


@query()
def als_fit_predict(t):
    train, validation, _ = _split_ratings(t)
    return R.als_fit_predict(train, validation, rank=4, iterations=5, reg=0.1, seed=5)


@query()
def als_select_rank(t):
    train, validation, _ = _split_ratings(t)
    return R.als_select_rank(train, validation, [4, 8, 12], iterations=5, reg=0.1, seed=5)[1]


@query()
def recommend_unrated(t):
    every = ratings(t)
    return R.recommend_unrated(every, titles(t), user=0, k=25, min_ratings=10, rank=8, iterations=5, reg=0.1, seed=5)


@query()
def pca_fit(t):
    model = P.pca_fit(vectors(t), "v", 3)
    return P.eigen_table(t.embeddings, model)


COVARIANCE_SQL = """
SELECT i, j, covar_pop(embedding[i]::DOUBLE, embedding[j]::DOUBLE) AS c
FROM embeddings, range(1, 65) a(i), range(1, 65) b(j) GROUP BY i, j
"""


@query(f"""
WITH c AS ({COVARIANCE_SQL})
SELECT 1 AS power, round(sum(c), 6) AS total FROM c WHERE i = j UNION ALL
SELECT 2, round(sum(c * c), 6) FROM c UNION ALL
SELECT 3, round(sum(x.c * y.c * z.c), 6) FROM c x JOIN c y ON x.j = y.i JOIN c z ON y.j = z.i AND z.j = x.i
""")
def pca_eigenvalue_moments(t):
    """Sums of powers of the eigenvalues, which are the traces of powers of the covariance."""
    model = P.pca_fit(vectors(t), "v", 1)
    rows = [(k, round(float((model.eigenvalues**k).sum()), 6)) for k in (1, 2, 3)]
    return t.spark.createDataFrame(rows, "power int, total double")


def components_sql(rows: str, k: int, d: int = 64, name: str = "") -> str:
    """Common tables of the first ``k`` components of a table ``v`` of vectors: ``w1`` and so on with ``w, l``.

    A power of the covariance by repeated squaring: its columns point along the first
    component. What that explains is taken off for the next one.
    """
    n = name
    size = "list_sum(list_transform(m, lambda z: list_dot_product(z, z)))"
    parts = [f"""{n}mean AS (SELECT list(x ORDER BY i) AS mean FROM (SELECT i, avg(v[i]) AS x FROM ({rows}), range(1, {d + 1}) a(i) GROUP BY i)),
    {n}m1 AS (SELECT list(r ORDER BY i) AS m FROM (SELECT i, list(c ORDER BY j) AS r FROM (
      SELECT i, j, covar_pop(v[i], v[j]) AS c FROM ({rows}), range(1, {d + 1}) a(i), range(1, {d + 1}) b(j) GROUP BY i, j) GROUP BY i)),
    {n}trace AS (SELECT list_sum(list_transform(range(1, {d + 1}), lambda i: m[i][i])) AS trace FROM {n}m1)"""]
    for i in range(1, k + 1):
        parts.append(f"""{n}p{i} AS (SELECT 0 AS step, m FROM {n}m{i} UNION ALL
      SELECT step + 1, list_transform(m, lambda r: list_transform(m, lambda q: list_dot_product(r, q) / size))
      FROM (SELECT step, m, {size} AS size FROM {n}p{i} WHERE step < 24)),
    {n}b{i} AS (SELECT m[list_position(diagonal, list_max(diagonal))] AS v
      FROM (SELECT m, list_transform(range(1, {d + 1}), lambda a: m[a][a]) AS diagonal FROM {n}p{i} WHERE step = 24)),
    {n}u{i} AS (SELECT list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS u FROM {n}b{i}),
    {n}s{i} AS (SELECT list_transform(u, lambda x: x * CASE WHEN list_max(u) >= -list_min(u) THEN 1 ELSE -1 END) AS w FROM {n}u{i}),
    {n}w{i} AS (SELECT w, list_dot_product(w, list_transform(m, lambda r: list_dot_product(r, w))) AS l FROM {n}s{i}, {n}m{i}),
    {n}m{i + 1} AS (SELECT list_transform(range(1, {d + 1}), lambda a: list_transform(range(1, {d + 1}), lambda b: m[a][b] - l * w[a] * w[b])) AS m
      FROM {n}m{i}, {n}w{i})""")
    return ",\n    ".join(parts)


VECTORS_SQL = "SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings"


@query(f"""
WITH RECURSIVE {components_sql(VECTORS_SQL, 1)}
SELECT (generate_subscripts(w, 1) - 1)::INT AS pos, round(unnest(w), 5) + 0.0 AS loading, round(l, 8) AS eigenvalue FROM w1
""")
def pca_first_component(t):
    model = P.pca_top(vectors(t), "v", 1)
    rows = [(i, float(x), float(model.eigenvalues[0])) for i, x in enumerate(model.components[:, 0])]
    found = t.spark.createDataFrame(rows, "pos int, loading double, eigenvalue double")
    return found.select("pos", r("loading", 5).alias("loading"), r("eigenvalue", 8).alias("eigenvalue"))


def scores_sql(rows: str, k: int, name: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT vec_id, {i}::INT AS pos, round(list_dot_product(v, w), 6) + 0.0 AS score FROM ({rows}), {name}w{i + 1}" for i in range(k)
    )


@query(f"WITH RECURSIVE {components_sql(VECTORS_SQL, 3)} {scores_sql(VECTORS_SQL, 3)}")
def pca_scores(t):
    scored = P.pca_scores(vectors(t), "v", 3).select("vec_id", F.posexplode("scores").alias("pos", "score"))
    return scored.withColumn("score", r("score", 6))


@query(f"""
WITH RECURSIVE {components_sql(VECTORS_SQL, 2)}
SELECT 1 AS k, round(w1.l / trace, 7) AS share FROM w1, trace UNION ALL SELECT 2, round((w1.l + w2.l) / trace, 7) FROM w1, w2, trace
""")
def variance_explained(t):
    model = P.pca_top(vectors(t), "v", 2)
    rows = [(k, round(model.variance_explained(k), 7)) for k in (1, 2)]
    return t.spark.createDataFrame(rows, "k int, share double")


@query(f"""
WITH RECURSIVE {components_sql(VECTORS_SQL, 1)},
p AS (SELECT vec_id, w, mean, list_dot_product(list_transform(v, lambda x, i: x - mean[i]), w) AS along FROM ({VECTORS_SQL}), w1, mean)
SELECT vec_id, (generate_subscripts(w, 1) - 1)::INT AS pos, round(unnest(list_transform(w, lambda x, i: x * along + mean[i])), 7) + 0.0 AS x FROM p
""")
def pca_reconstruct(t):
    projected = P.pca_reconstruct(vectors(t), "v")
    return projected.select("vec_id", F.posexplode("projected").alias("pos", "x")).withColumn("x", r("x", 7))


def _series(t):
    # shifted so that no series mean is near 0, as pixel intensities are not
    return vectors(t).select("vec_id", "label", F.transform("v", lambda x: x + 1).alias("ts"))


SERIES_SQL = """SELECT vec_id, list_transform(s, lambda x: (x - m) / m) AS s
FROM (SELECT vec_id, s, list_avg(s) AS m FROM (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: x + 1) AS s FROM embeddings))"""
FOLDS_SQL = {
    "period": f"SELECT vec_id, list_transform(range(8), lambda p: list_sum(list_transform(range(8), lambda i: s[8 * i + p + 1]))) AS v FROM ({SERIES_SQL})",
    "block": f"SELECT vec_id, list_transform(range(8), lambda p: list_sum(s[8 * p + 1:8 * p + 8])) AS v FROM ({SERIES_SQL})",
}


@query(f"""
WITH RECURSIVE {", ".join(components_sql(rows, 3, 8, name) for name, rows in FOLDS_SQL.items())}
{" UNION ALL ".join(f"SELECT *, '{name}' AS fold FROM ({scores_sql(rows, 3, name)})" for name, rows in FOLDS_SQL.items())}
""")
def series_pca(t):
    by_period = P.series_pca(_series(t), fold_by_period(rescale_series(F.col("ts")), 8), 3)[1]
    by_block = P.series_pca(_series(t), fold_by_block(rescale_series(F.col("ts")), 8), 3)[1]
    both = by_period.withColumn("fold", F.lit("period")).unionByName(by_block.withColumn("fold", F.lit("block")))
    scored = both.select("vec_id", "fold", F.posexplode("scores").alias("pos", "score"))
    return scored.withColumn("score", r("score", 6))
