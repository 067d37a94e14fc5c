"""Ranks, running totals, exact quantiles and chunked lists."""

import statistics

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Row, functions as F

from quern.operators import aggregates as A, ordering as O, stats as S


def test_zip_with_index_with_a_frequent_key(spark):
    rows = spark.range(1000).select(F.when(F.col("id") < 400, 7).otherwise(F.col("id") % 10).alias("k"), "id")
    got = [(r.k, r.id, r["index"]) for r in O.zip_with_index(rows.repartition(5), ["k", "id"]).collect()]
    expected = sorted((r.k, r.id) for r in rows.collect())
    assert sorted(got, key=lambda r: r[2]) == [(k, i, n) for n, (k, i) in enumerate(expected)]


def test_running_totals(spark):
    rows = spark.range(500).select("id", (F.col("id") % 7).alias("v"))
    got = {r.id: r.upto for r in O.running_totals(rows, [F.desc("id")], {"upto": "v"}).collect()}
    total = 0
    for i in reversed(range(500)):
        total += i % 7
        assert got[i] == total


@pytest.mark.parametrize("chunk", [1, 2, 4, 1000])
def test_collect_by_key_keeps_every_value_and_key(spark, chunk):
    rows = spark.createDataFrame(
        [("a", i % 5) for i in range(23)] + [("b", None), ("c", 2), ("c", 1), ("c", None), (None, 7), (None, 6), (None, None)],
        "k string, v int",
    )
    lists = O.collect_by_key(rows, "k", "v", chunk).orderBy("k", "chunk").collect()
    assert all(len(r["values"]) <= chunk for r in lists)
    joined = {}
    for r in lists:
        joined.setdefault(r.k, []).extend(r["values"])
    assert joined == {"a": sorted(i % 5 for i in range(23)), "b": [], "c": [1, 2], None: [6, 7]}
    assert [r.chunk for r in lists if r.k == "a"] == list(range(-(-23 // chunk)))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=60))
def test_mean_median(spark, values):
    rows = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
    got = S.mean_median(rows, "v").first()
    assert got["median"] == pytest.approx(statistics.median(values), rel=1e-12, abs=1e-9)
    assert got["mean"] == pytest.approx(statistics.fmean(values), rel=1e-9, abs=1e-6)


def test_value_at_rank_narrows_in_rounds(spark):
    rows = spark.range(5000).select((F.col("id") * F.col("id")).cast("double").alias("v"))
    heavy = rows.unionAll(spark.range(5000).select(F.lit(9.0).alias("v")))
    values = sorted(r.v for r in heavy.collect())
    for rank in (0, 3, 4, 5002, 5003, 7000, 9999):
        assert O.value_at_rank(heavy, "v", rank, bins=4) == values[rank]


def test_values_at_many_ranks(spark):
    rows = spark.range(0, 4000, numPartitions=5).select((F.col("id") * 7919 % 4001 - 1000).alias("v"))
    hot = rows.unionAll(spark.range(2000).select(F.lit(2**60 + 1).alias("v"))).unionAll(spark.createDataFrame([(None,)], "v bigint"))
    values = sorted(r.v for r in hot.collect() if r.v is not None)
    ranks = [0, 5999, 6000, 3999, 4000, 17, 17, *range(0, 6000, 101)]
    for cells in (3, 50, 1000):
        assert O.values_at_ranks(hot, "v", ranks, cells) == [values[r] if r < 6000 else None for r in ranks]
    assert O.values_at_ranks(hot, "v", []) == [] and O.values_at_ranks(hot.limit(0), "v", [0]) == [None]


def test_brackets_that_miss_are_widened(spark):
    rows = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    sketch = O.quantile_sketch(rows, "v", 10)
    wrong = Row(**{**sketch.asDict(), "marks": [0.0, *[1.0] * 9, 999.0]})
    assert O.values_at_ranks(rows, "v", [500, 20], 10, wrong) == [500.0, 20.0]


@pytest.mark.parametrize(
    "values, median",
    [
        ([1.0, 2.0, 3.0, float("nan"), 9.0], 3.0),
        ([float("inf"), 1.0, 2.0], 2.0),
        ([float("-inf"), float("-inf"), 1.0], float("-inf")),
        ([float("inf"), float("inf"), 1.0], float("inf")),
        ([1e308, -1e308, 5e307], 5e307),
        ([5e-324, 0.0, 1e-323], 5e-324),
    ],
)
def test_median_of_odd_values(spark, values, median):
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    assert S.mean_median(rows, "v").first()["median"] == median
    assert rows.agg(F.percentile("v", 0.5)).first()[0] == median


def test_rank_beyond_the_values(spark):
    rows = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "v double")
    assert O.value_at_rank(rows, "v", 0) == 1.0 and O.value_at_rank(rows, "v", 2) is None
    assert O.value_at_rank(rows, "v", 1) != O.value_at_rank(rows, "v", 1)  # NaN


def test_median_of_nothing(spark):
    assert tuple(S.mean_median(spark.createDataFrame([], "v double"), "v").first()) == (None, None)


def test_counts(spark):
    rows = spark.createDataFrame([(v,) for v in [1, 2, 3, 1, 2, 3, 1, 2, 1, 2, 3, 3, 3, 4, 5, 4, 6]], "v int")
    assert {r.v: r.n for r in A.count_by_key(rows, "v").collect()} == {1: 4, 2: 4, 3: 5, 4: 2, 5: 1, 6: 1}


def test_word_counts(spark):
    rows = spark.createDataFrame([(w,) for w in "cat elephant rat rat cat".split()], "w string")
    assert {r.w: r.n for r in A.count_by_key(rows, "w").collect()} == {"cat": 2, "elephant": 1, "rat": 2}
    assert tuple(A.mean_count_per_unique(rows, "w").first()) == (5, 3, 1.67)


def test_count_mean_by_key(spark):
    lists = {1: [1, 2, 3, 4], 100: [10, 20, 30], 110: range(20)}
    rows = spark.createDataFrame([(k, v) for k, vs in lists.items() for v in vs], "k int, v int")
    got = {r.k: (r.n, r["mean"]) for r in A.count_mean_by_key(rows, "k", "v").collect()}
    assert got == {1: (4, 2.5), 100: (3, 20.0), 110: (20, 9.5)}


def test_power_of_two_buckets(spark):
    rows = spark.createDataFrame([(n,) for n in (1, 2, 3, 4, 5, 8, 9, 1024, 1025)], "n int")
    got = {r.bucket: r["keys"] for r in A.histogram_pow2(rows, "n").collect()}
    assert got == {1: 1, 2: 1, 4: 2, 8: 2, 16: 1, 1024: 1, 2048: 1}


def test_fixed_histogram(spark):
    rows = spark.createDataFrame([(float(v),) for v in range(11)], "v double")
    assert {r.bin: r.n for r in A.histogram_fixed(rows, "v", 5).collect()} == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}
    same = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert [tuple(r) for r in A.histogram_fixed(same, "v", 5).collect()] == [(0, 2)]


@pytest.mark.parametrize(
    "t, dof, p",
    [(0.0, 5, 1.0), (1.0, 1, 0.5), (2.0, 2, 0.18350341907227397), (2.570581835636314, 5, 0.05), (12.706204736432095, 1, 0.05)],
)
def test_student_t(t, dof, p):
    assert S.student_t_two_sided(t, dof) == pytest.approx(p, rel=1e-9)
    assert S.student_t_two_sided(-t, dof) == pytest.approx(p, rel=1e-9)


def test_student_t_far_out_is_zero():
    assert S.student_t_two_sided(60.0, 1e6) == 0.0


def test_welch(spark):
    a, b = [1.0, 2.0, 3.0, 4.0], [2.0, 4.0, 6.0, 8.0, 10.0]
    rows = spark.createDataFrame([("a", v) for v in a] + [("b", v) for v in b], "g string, v double")
    got = S.welch_t_test(rows, "g", "v").first()
    ea, eb = statistics.variance(a) / 4, statistics.variance(b) / 5
    assert got["t"] == pytest.approx((2.5 - 6) / (ea + eb) ** 0.5)
    assert got["df"] == pytest.approx((ea + eb) ** 2 / (ea**2 / 3 + eb**2 / 4))
    assert 0.05 < got["p"] < 0.1


def test_roc_curve(spark):
    rows = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.8, 1), (0.1, 0)], "s double, y int")
    got = [tuple(r) for r in S.roc_curve(rows, "s", "y").orderBy(F.desc("score")).collect()]
    assert got == [(0.9, 1, 0, 0.5, 0.0), (0.8, 2, 1, 1.0, 0.5), (0.1, 2, 2, 1.0, 1.0)]


def test_roc_curve_of_one_class(spark):
    rows = spark.createDataFrame([(0.9, 1), (0.1, 1)], "s double, y int")
    assert [tuple(r) for r in S.roc_curve(rows, "s", "y").orderBy(F.desc("score")).collect()] == [
        (0.9, 1, 0, 0.5, None), (0.1, 2, 0, 1.0, None)
    ]


@pytest.mark.parametrize("rows", [[([1.0, 2.0, 3.0],), ([4.0],)], [([1.0, 2.0, 3.0, 4.0],), (None,)], [([1.0, None],)]])
def test_ragged_vectors_are_refused(spark, rows):
    with pytest.raises(Exception, match="one length|null|imension|size"):
        S.covariance_matrix(spark.createDataFrame(rows, "v array<double>").coalesce(1), "v").collect()


def test_sort_by_key_is_in_order(spark, data):
    from quern.plans.catalog import QUERIES

    df = QUERIES["sort_by_key"](spark, data)
    rows = [tuple(r) for r in df.collect()]
    assert [r[0] for r in rows] == sorted(r[0] for r in rows)


def test_binned_roc_is_part_of_the_whole(spark):
    rows = spark.range(3000).select((F.col("id") * 7919 % 3001 / 7.0).alias("s"), (F.col("id") * 31 % 100 < F.col("id") / 60).cast("int").alias("t"))
    odd = rows.unionAll(spark.createDataFrame([(float("nan"), 1), (float("inf"), 0), (None, 1)], "s double, t int"))
    whole = {str(r.score): (r.tp, r.fp) for r in S.roc_curve(odd.filter("s is not null"), "s", "t").collect()}
    binned = S.roc_curve(odd, "s", "t", bins=40)
    points = binned.collect()
    assert 40 <= len(points) <= 41 and all(whole[str(r.score)] == (r.tp, r.fp) for r in points)
    exact = S.roc_area(S.roc_curve(odd.filter("s is not null"), "s", "t")).first()
    rough = S.roc_area(binned).first()
    assert exact.error == pytest.approx(0, abs=1e-9) and abs(exact.area - rough.area) <= rough.error < 0.02
    assert S.roc_curve(odd.limit(0), "s", "t", bins=4).count() == 0
