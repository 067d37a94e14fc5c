"""Models against direct computation, Spark's own SGD, and known values."""

import numpy as np
import pytest
from pyspark.mllib.classification import LogisticRegressionWithSGD
from pyspark.mllib.linalg import SparseVector
from pyspark.mllib.regression import LabeledPoint, LinearRegressionWithSGD
from pyspark.sql import functions as F

from quern.functions.vectors import fold_by_period, rescale_series
from quern.operators import logistic as L, pca as P, recommend as R, regression as G, stats as S

POINTS = "label double, features array<double>"


def frame(spark, x, y):
    return spark.createDataFrame([(float(b), [float(v) for v in a]) for a, b in zip(x, y)], POINTS)


@pytest.fixture(scope="module")
def linear(spark):
    rng = np.random.default_rng(0)
    x = rng.random((400, 3))
    y = x @ [2.0, -1.0, 0.5] + 3 + rng.normal(0, 0.1, 400)
    return x, y, frame(spark, x, y).repartition(3).cache()


def test_rmse(spark):
    rows = spark.createDataFrame([(3.0, 1.0), (1.0, 2.0), (2.0, 2.0)], "prediction double, label double")
    assert G.rmse(rows).first().rmse == pytest.approx(1.29099444874)


def test_shift_label(spark):
    rows = frame(spark, [[1], [1], [1]], [1922, 2001, 1950])
    assert [r.label for r in G.shift_label(rows, "label").collect()] == [0, 79, 28]


def test_prediction(spark):
    got = G.linreg_predict(frame(spark, [[1, 0.5], [0.5, 0.5]], [2, 1.5]), [1, 1.5])
    assert [tuple(r) for r in got.collect()] == [(2.0, 1.75), (1.5, 1.25)]


@pytest.mark.parametrize(
    "w, x, y, summand",
    [
        ([1, 1, 1], [3, 1, 4], 2, [18, 6, 24]),
        ([0.24, 1.2, -1.4], [-1.4, 4.2, 2.1], 3, [1.7304, -5.1912, -2.5956]),
    ],
)
def test_gradient_summand(spark, w, x, y, summand):
    assert G.gradient_summand(frame(spark, [x], [y]), w).first().summand == pytest.approx(summand)


def test_gradient_descent_equals_row_by_row_descent(linear):
    x, y, df = linear
    model = G.linreg_gd(df, 20)
    w = np.zeros(3)
    for i in range(20):
        assert model.errors[i] == pytest.approx(np.sqrt(np.mean((x @ w - y) ** 2)), rel=1e-9)
        w = w - 1.0 / (len(y) * np.sqrt(i + 1)) * ((x @ w - y) @ x)
    assert model.weights == pytest.approx(w, rel=1e-9)


@pytest.mark.parametrize("reg", [0.0, 0.1])
def test_linear_sgd_equals_spark(linear, reg):
    x, y, df = linear
    rdd = df.sparkSession.sparkContext.parallelize([LabeledPoint(b, a) for a, b in zip(x, y)])
    theirs = LinearRegressionWithSGD.train(
        rdd, iterations=40, step=1.0, miniBatchFraction=1.0, regParam=reg, regType="l2", intercept=True, convergenceTol=0.0
    )
    ours = G.linreg_sgd(df, iterations=40, step=1.0, reg=reg)
    assert ours.weights == pytest.approx(np.asarray(theirs.weights), rel=1e-9)
    assert ours.intercept == pytest.approx(theirs.intercept, rel=1e-9)


def test_mini_batches_come_close_to_the_full_batch(linear):
    df = linear[2].withColumn("key", F.monotonically_increasing_id())
    part = G.linreg_sgd(df, iterations=15, step=1.0, fraction=0.5, key="key")
    whole = G.linreg_sgd(df, iterations=15, step=1.0)
    assert part.weights == pytest.approx(whole.weights, abs=0.2) and list(part.weights) != list(whole.weights)
    with pytest.raises(ValueError):
        G.linreg_sgd(df, iterations=1, fraction=0.5)


def test_mini_batches_are_those_of_one_pass_each(linear):
    from quern.functions.hashing import unit_hash

    df = linear[2].withColumn("key", F.col("label") * 1000)
    got = G.batch_moments(df, 6, 0.3, "key", 42)
    for i in range(1, 7):
        assert got[i].total == pytest.approx(G.moments(df.filter(unit_hash(F.col("key"), 42 + i) < 0.3)).total)
    few = G.batch_moments(df, 200, 0.002, "key", 1)
    assert 0 < len(few) < 200 and G.linreg_sgd(df, iterations=200, fraction=0.002, key="key", seed=1).weights.shape == (len(linear[0][0]),)


def test_top_components_of_long_vectors(spark):
    rng = np.random.default_rng(2)
    for n, d, k in ((300, 40, 3), (25, 120, 5), (400, 6, 4)):
        x = rng.normal(size=(n, d)) * np.linspace(3, 0.2, d) + rng.normal(size=d)
        df = spark.createDataFrame([(row.tolist(),) for row in x], "v array<double>").repartition(3)
        model = P.pca_top(df, "v", k)
        values, vectors = np.linalg.eigh(np.cov(x.T, bias=True))
        assert model.eigenvalues[:k] == pytest.approx(values[::-1][:k], rel=1e-9)
        assert np.abs(np.abs(np.diag(model.components.T @ vectors[:, ::-1][:, :k])) - 1).max() < 1e-6
        assert model.variance_explained(1) == pytest.approx(values[-1] / values.sum())
        assert all(c[np.abs(c).argmax()] > 0 for c in model.components.T)


def test_top_components_of_vectors_on_a_line(spark):
    df = spark.createDataFrame([([float(x), 2.0 * x, 0.0],) for x in range(9)], "v array<double>")
    model = P.pca_top(df, "v", 2)
    assert model.components[:, 0] == pytest.approx(np.array([1, 2, 0]) / 5**0.5) and model.eigenvalues[1:] == pytest.approx(0, abs=1e-9)
    same = P.pca_top(spark.createDataFrame([([1.0, 2.0],)] * 4, "v array<double>"), "v", 1)
    assert same.eigenvalues[0] == 0
    with pytest.raises(ValueError):
        P.pca_top(df.limit(0), "v", 1)


def test_user_folded_in_as_a_fit_would(spark):
    rng = np.random.default_rng(4)
    users, items = rng.normal(size=(40, 3)) + 1, rng.normal(size=(30, 3)) + 1
    rows = [(u, i, float(users[u] @ items[i])) for u in range(40) for i in range(30) if rng.random() < 0.6]
    ratings = spark.createDataFrame(rows, "user int, item int, rating double")
    new = ratings.filter("user >= 35")
    model = R.als_fit(ratings.filter("user < 35"), 3, iterations=10, reg=0.01)
    factors = R.factors_of(model)
    folded = R.fold_in(factors, new, 0.01)
    f = {r.item: np.array(r.features) for r in factors.collect()}
    for row in folded.collect():
        mine = [(i, x) for u, i, x in rows if u == row.user and i in f]
        a = np.array([f[i] for i, _ in mine])
        expected = np.linalg.solve(a.T @ a + 0.01 * len(mine) * np.eye(3), a.T @ np.array([x for _, x in mine]))
        assert row.features == pytest.approx(expected, rel=1e-9)
    assert folded.count() == 5
    mine = R.rmse_join(R.predict_folded(factors, folded, new), new).first().rmse
    refit = R.als_fit(ratings, 3, iterations=10, reg=0.01).transform(new).select("user", "item", "prediction")
    assert mine < R.rmse_join(refit, new).first().rmse + 0.1
    assert R.fold_in(factors, new.withColumn("item", F.lit(999)), 0.01).count() == 0


def test_recommendation_without_another_fit(spark):
    rng = np.random.default_rng(5)
    rows = [(u, i, float(1 + (u + i) % 5)) for u in range(30) for i in range(20) if rng.random() < 0.7]
    ratings = spark.createDataFrame(rows, "user int, item int, rating double")
    items = spark.createDataFrame([(i, f"item {i:02d}") for i in range(20)], "item int, title string")
    model = R.als_fit(ratings, 4, iterations=8)
    own = spark.createDataFrame([(i, 5.0 if i % 2 else 1.0) for i in range(8)], "item int, rating double")
    got = R.recommend_unrated(ratings, items, -1, k=50, min_ratings=0, model=model, own=own).collect()
    assert {r.title for r in got} == {f"item {i:02d}" for i in range(8, 20)}
    assert [r.prediction for r in got] == sorted((r.prediction for r in got), reverse=True)


def test_blocks_multiply_as_matrices(spark):
    from quern.operators.matrices import matrix_multiply

    rng = np.random.default_rng(6)
    for fill in (0.02, 0.9):
        a, b = (rng.integers(1, 9, size=s) * (rng.random(s) < fill) for s in ((37, 50), (50, 23)))
        cells = [spark.createDataFrame([(int(i) - 5, int(j) - 5, float(m[i, j])) for i, j in zip(*np.nonzero(m))], "i bigint, j bigint, v double") for m in (a, b)]
        for size in (7, 512):
            got = {(r.i + 5, r.j + 5): r.v for r in matrix_multiply(*cells, size).collect()}
            reached = (a > 0).astype(int) @ (b > 0).astype(int)
            assert got == {(i, j): (a @ b)[i, j] for i, j in zip(*np.nonzero(reached))}
        assert matrix_multiply(cells[0].limit(0), cells[1]).count() == 0


def test_grid_keeps_the_best_model(linear):
    df = linear[2]
    grid = [{"iterations": 200, "step": 1.0, "reg": r} for r in (1e-10, 1.0)] + [{"iterations": 200, "step": 10.0, "reg": 0.0}]
    best, table = G.grid_search(df, df, grid)
    errors = {r.setting: r.rmse for r in table.collect()}
    assert min(errors.values()) == errors["iterations=200, step=1, reg=1e-10"]
    scored = df.select("label", best.predict(F.col("features")).alias("prediction"))
    assert G.rmse(scored).first().rmse == pytest.approx(min(errors.values()), rel=1e-6)


def test_interactions_help_where_the_truth_has_them(spark):
    rng = np.random.default_rng(1)
    x = rng.random((500, 2))
    df = frame(spark, x, x[:, 0] * x[:, 1])
    setting = {"iterations": 500, "step": 1.0, "reg": 1e-10}
    plain = G.moments(df)
    model = G.linreg_sgd(df, **setting)
    _, table = G.linreg_interactions(df, {"all": df}, **setting)
    assert table.first().rmse < plain.rmse(model.weights, model.intercept)


def test_mean_baseline(spark):
    train, other = frame(spark, [[0], [0]], [1, 3]), frame(spark, [[0]], [5])
    got = {r.part: r.rmse for r in G.mean_baseline(train, {"train": train, "other": other}, "label").collect()}
    assert got == {"train": 1.0, "other": 3.0}


@pytest.fixture(scope="module")
def clicks(spark):
    rng = np.random.default_rng(2)
    rows = []
    for _ in range(600):
        idx = sorted({int(rng.integers(0, 5)), int(rng.integers(5, 10))})
        p = 1 / (1 + np.exp(-(1.5 if 0 in idx else -1.0)))
        rows.append((float(rng.random() < p), idx))
    return rows, spark.createDataFrame(rows, "label double, idx array<bigint>").repartition(3)


def test_logistic_sgd_equals_spark(clicks, spark):
    rows, df = clicks
    rdd = spark.sparkContext.parallelize([LabeledPoint(y, SparseVector(10, idx, [1.0] * len(idx))) for y, idx in rows])
    theirs = LogisticRegressionWithSGD.train(
        rdd, iterations=15, step=10.0, regParam=1e-6, regType="l2", intercept=True, convergenceTol=0.0
    )
    ours = L.logreg_sgd(df, 10, iterations=15, step=10.0, reg=1e-6)
    assert ours.weights == pytest.approx(np.asarray(theirs.weights), rel=1e-6, abs=1e-9)
    assert ours.intercept == pytest.approx(theirs.intercept, rel=1e-6)


def test_logistic_model_beats_the_constant_rate(clicks, spark):
    from quern.operators.features import predict_proba

    df = clicks[1].withColumn("id", F.monotonically_increasing_id()).cache()
    model = L.logreg_sgd(df, 10, iterations=30)
    scored = predict_proba(df, model.weight_table(spark), model.intercept, "id")
    fitted = L.evaluate_log_loss(scored).first().log_loss
    assert fitted < L.log_loss_baseline(df, {"all": df}, "label").first().log_loss


@pytest.mark.parametrize("rows, buckets", [(7, 50), (1 << 17, 1 << 19)])
def test_steps_leave_the_blocks_in_their_buckets(clicks, monkeypatch, rows, buckets):
    df = clicks[1]
    expected = L.logreg_sgd(df, 10, iterations=3)
    steps, stable = [], L.stable

    def seen(table, **options):
        plan = table._jdf.queryExecution().executedPlan().toString()
        if "labels#" in plan:
            steps.append(plan)
        return stable(table, **options)

    monkeypatch.setattr(L, "BLOCK_ROWS", rows)
    monkeypatch.setattr(L, "BUCKET_ROWS", buckets)
    monkeypatch.setattr(L, "stable", seen)
    df.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = L.logreg_sgd(df, 10, iterations=3)
    finally:
        df.sparkSession.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found.weights == pytest.approx(expected.weights)
    assert found.intercept == pytest.approx(expected.intercept)
    assert len(steps) == 3
    for plan in steps:
        blocks = plan.split("SortMergeJoin [block#")[1].split("Sort [block#")[1]  # the side with the blocks
        assert "labels#" in blocks and "Bucketed: true" in blocks and "Exchange" not in blocks


def test_values_other_than_one(spark):
    df = spark.createDataFrame([(1.0, [0], [2.0]), (0.0, [1], [0.5])], "label double, idx array<bigint>, val array<double>")
    model = L.logreg_sgd(df, 2, iterations=1, step=1.0, reg=0.0)
    p = 1 / (1 + np.exp(-1.0))  # weights start at 0, the intercept at 1
    assert model.weights == pytest.approx([-(p - 1) * 2.0 / 2, -p * 0.5 / 2])
    assert model.intercept == pytest.approx(1 - ((p - 1) + p) / 2)


def test_pca_of_a_line(spark):
    rows = spark.createDataFrame([([float(x + i) for i in range(4)],) for x in range(0, 20, 4)], "v array<double>")
    model = P.pca_fit(rows, "v", 3)
    assert model.components[:, 0] == pytest.approx([0.5] * 4)
    assert model.eigenvalues == pytest.approx([128, 0, 0, 0], abs=1e-6)
    first = P.pca_scores(rows, "v", 3, model).orderBy(F.col("v")[0]).first()
    assert abs(first.scores[0]) == pytest.approx(3.0)


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 3)) @ np.array([[2, 0.5, 0], [0, 1, 0.3], [0, 0, 0.1]]) + [50, 40, 3]
    return x, spark.createDataFrame([(row.tolist(),) for row in x], "v array<double>").repartition(4).cache()


def test_covariance(cloud):
    x, df = cloud
    got = np.zeros((3, 3))
    for r in S.covariance_matrix(df, "v").collect():
        got[r.i, r.j] = r["cov"]
    assert got == pytest.approx(np.cov(x.T, bias=True), rel=1e-9)


def test_pca_equals_an_eigen_decomposition(cloud):
    x, df = cloud
    values, vectors = np.linalg.eigh(np.cov(x.T, bias=True))
    model = P.pca_fit(df, "v", 2)
    assert model.eigenvalues == pytest.approx(values[::-1], rel=1e-8)
    assert np.abs(model.components) == pytest.approx(np.abs(vectors[:, ::-1][:, :2]), rel=1e-6, abs=1e-9)
    assert model.variance_explained(2) == pytest.approx(values[::-1][:2].sum() / values.sum())
    scores = np.array([r.scores for r in P.pca_scores(df, "v", 2, model).collect()])
    assert scores.var(axis=0) == pytest.approx(model.eigenvalues[:2], rel=1e-8)


def test_reconstruction_lies_on_the_first_component(cloud):
    x, df = cloud
    model = P.pca_fit(df, "v", 1)
    got = P.pca_reconstruct(df, "v", model).collect()
    c = model.components[:, 0]
    for r in got[:20]:
        assert r.projected == pytest.approx((np.array(r.v) - x.mean(0)) @ c * c + x.mean(0))


def test_series_keep_their_keys(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.random(6) + 1).tolist()) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, ts array<double>")
    model, scored = P.series_pca(df, fold_by_period(rescale_series(F.col("ts")), 3), 2)
    folded = np.array([[(np.array(ts) / np.mean(ts) - 1)[p::3].sum() for p in range(3)] for _, ts in rows])
    assert model.eigenvalues == pytest.approx(np.linalg.eigvalsh(np.cov(folded.T, bias=True))[::-1], rel=1e-6, abs=1e-12)
    assert sorted(r.id for r in scored.collect()) == list(range(40))


@pytest.fixture(scope="module")
def rated(spark):
    rng = np.random.default_rng(6)
    users, items = rng.random((30, 2)) + 0.5, rng.random((20, 2)) + 0.5
    rows = [(u, i, float(users[u] @ items[i])) for u in range(30) for i in range(20) if (u * 7 + i) % 4]
    held = [(u, i, float(users[u] @ items[i])) for u in range(30) for i in range(20) if not (u * 7 + i) % 4]
    schema = "user int, item int, rating double"
    return spark.createDataFrame(rows, schema).cache(), spark.createDataFrame(held, schema).cache()


def test_factors_beat_the_mean(rated):
    train, held = rated
    _, table = R.als_select_rank(train, held, [2, 4], iterations=8, reg=0.01)
    baseline = G.mean_baseline(train, {"held": held}, "rating").first().rmse
    assert min(r.rmse for r in table.collect()) < 0.3 * baseline


def test_recommendations_leave_out_rated_items(rated, spark):
    train, _ = rated
    items = spark.range(20).select(F.col("id").cast("int").alias("item"), F.concat(F.lit("t"), "id").alias("title"))
    got = R.recommend_unrated(train, items, user=3, k=25, min_ratings=5, rank=2, iterations=5).collect()
    seen = {f"t{r.item}" for r in train.filter("user = 3").collect()}
    assert got and not seen & {r.title for r in got}
    assert [r.prediction for r in got] == sorted((r.prediction for r in got), reverse=True)
    assert all(r.n > 5 for r in got)


def test_top_rated(spark):
    rows = [(u, 1, 5.0) for u in range(3)] + [(u, 2, 4.0) for u in range(5)] + [(u, 3, 4.0) for u in range(5)]
    ratings = spark.createDataFrame(rows, "user int, item int, rating double")
    items = spark.createDataFrame([(1, "one"), (2, "two"), (3, "three")], "item int, title string")
    assert [tuple(r) for r in R.top_rated(ratings, items, 3, 5).collect()] == [(4.0, "two", 5), (4.0, "three", 5)]
