"""Skew-proof joins against plain joins, on data where one key has a third of the rows."""

import pytest
from pyspark.sql import functions as F

from quern.operators import joins as J
from quern.operators.matrices import matrix_multiply, transpose
from quern.session import stable


@pytest.fixture(scope="module")
def skewed(spark):
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50)
    return spark.range(3000).select(key.alias("k"), F.col("id").alias("x")).cache()


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("y")).cache()


def bag(df):
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "left_semi", "left_anti"])
def test_lookup_join(skewed, lookup, how):
    assert bag(J.lookup_join(skewed, lookup, "k", how).na.fill(-1)) == bag(skewed.join(lookup, "k", how).na.fill(-1))


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_a_key_with_a_third_of_the_rows_is_cut(spark, how):
    """Adaptive execution reads the partition of the frequent key in several tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 120_000, 1, 12).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.md5(F.col("id").cast("string")).alias("x")
        )
        lookup = stable(spark.range(50_000).select(F.col("id").alias("k"), F.lit(1).alias("y")))
        joined = J.lookup_join(rows, lookup, "k", how)
        assert joined.count() == {"inner": 73_333, "left": 120_000, "left_anti": 46_667}[how]
        joined.collect()
        assert "skewed" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in settings:
            spark.conf.unset(k)


@pytest.mark.parametrize("cell_rows", [7, 100, 100_000])
def test_grid_join(skewed, spark, cell_rows):
    right = spark.range(400).select((F.col("id") % 7 * F.col("id") % 2).alias("k"), F.col("id").alias("z"))
    assert bag(J.grid_join(skewed, right, "k", "x", "z", cell_rows)) == bag(skewed.join(right, "k"))


def test_grid_join_bounds_every_cell(skewed, spark):
    right = spark.range(600).select(F.lit(0).cast("bigint").alias("k"), F.col("id").alias("z"))
    sizes = spark.createDataFrame([(0, 11, 7)], "k bigint, _across int, _down int")
    left = skewed.join(sizes, "k")
    joined = J.grid_join_sized(left, right.join(sizes, "k"), ["k"], "x", "z")
    n = skewed.filter("k = 0").count()
    assert joined.count() == n * 600 == joined.distinct().count()


def test_left_join_default(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, 5)], "k int, v int")
    assert bag(J.left_join_default(left, right, "k", {"v": 0})) == [(1, 5), (2, 0)]


@pytest.mark.parametrize("upper_both, matches", [(True, 2), (False, 1)])
def test_geocode_join(spark, upper_both, matches):
    amounts = spark.createDataFrame([("12 Main St", 3.0), ("7 OAK AVE", 4.0)], "place string, amount double")
    points = spark.createDataFrame(
        [("12", "Main St", 1.0, 2.0), ("7", "Oak Ave", 3.0, 4.0)], "number string, street string, lon double, lat double"
    )
    assert J.geocode_join(amounts, points, "place", "number", "street", upper_both).count() == matches


def coordinates(spark, rows):
    cells = [(i, j, float(v)) for i, row in enumerate(rows) for j, v in enumerate(row)]
    return spark.createDataFrame(cells, "i int, j int, v double")


def test_matrix_products(spark):
    a = coordinates(spark, [[1, 2, 3], [4, 5, 6]])
    b = coordinates(spark, [[1, 2], [3, 4], [5, 6]])
    assert bag(matrix_multiply(a, b)) == [(0, 0, 22.0), (0, 1, 28.0), (1, 0, 49.0), (1, 1, 64.0)]
    c = coordinates(spark, [[1, 2, 3, 4], [5, 6, 7, 8]])
    assert bag(matrix_multiply(c, transpose(c))) == [(0, 0, 30.0), (0, 1, 70.0), (1, 0, 70.0), (1, 1, 174.0)]
