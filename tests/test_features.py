"""One-hot and hashed features, splits, samples and user functions."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quern.operators import features as C, recommend as R, sampling as S, udfs as U

ANIMALS = {
    1: [(0, "mouse"), (1, "black")],
    2: [(0, "cat"), (1, "tabby"), (2, "mouse")],
    3: [(0, "bear"), (1, "black"), (2, "salmon")],
}
SCHEMA = "id int, features array<struct<feature int, value string>>"


@pytest.fixture(scope="module")
def animals(spark):
    return spark.createDataFrame(list(ANIMALS.items()), SCHEMA)


def test_one_hot_dict(animals):
    got = {(r.feature, r.value): r.idx for r in C.one_hot_dict(animals).collect()}
    assert got == {
        (0, "bear"): 0, (0, "cat"): 1, (0, "mouse"): 2, (1, "black"): 3, (1, "tabby"): 4, (2, "mouse"): 5, (2, "salmon"): 6
    }


def test_one_hot_encode(animals, spark):
    dictionary = C.one_hot_dict(animals)
    assert {r.id: r.idx for r in C.one_hot_encode(animals, dictionary, "id").collect()} == {
        1: [2, 3], 2: [1, 4, 5], 3: [0, 3, 6]
    }
    unseen = spark.createDataFrame([(9, [(1, "black"), (0, "dog")]), (10, [(0, "dog")])], SCHEMA)
    assert {r.id: r.idx for r in C.one_hot_encode(unseen, dictionary, "id").collect()} == {9: [3], 10: []}


def test_hash_features(animals):
    def hashed(buckets):
        rows = animals.select("id", C.hash_features(F.col("features"), buckets).alias("h")).collect()
        return {r.id: r.h for r in rows}

    assert hashed(4)[1] == {2: 1.0, 3: 1.0}
    assert hashed(100)[3] == {72: 1.0, 5: 1.0, 14: 1.0}


def test_equal_texts_of_two_features_count_once(spark):
    rows = spark.createDataFrame([(1, [(1, "a"), (11, "a"), (1, "a1")])], SCHEMA)
    # "a1", "a11" and again "a11"
    counts = rows.select(C.hash_features(F.col("features"), 2**30).alias("h")).first().h
    assert sum(counts.values()) == 2.0


def test_sparsity(animals):
    encoded = C.one_hot_encode(animals, C.one_hot_dict(animals), "id")
    assert C.sparsity(encoded, F.size("idx"), 7).first().sparsity == pytest.approx(8 / 3 / 7)


def test_predict_proba(spark):
    points = spark.createDataFrame([(1, [0, 2]), (2, []), (3, [1])], "id int, idx array<bigint>")
    weights = spark.createDataFrame([(0, 0.5), (1, -40.0), (2, 1.0)], "idx bigint, w double")
    got = {r.id: r.p for r in C.predict_proba(points, weights, 0.25, "id").collect()}
    assert got == pytest.approx({1: 1 / (1 + np.exp(-1.75)), 2: 1 / (1 + np.exp(-0.25)), 3: 1 / (1 + np.exp(20))})


def test_split_is_disjoint_whole_and_repeatable(spark):
    rows = spark.range(5000)
    parts = S.random_split(rows, "id", [8.0, 1.0, 1.0], 42)
    sizes = [p.count() for p in parts]
    assert sum(sizes) == 5000 and abs(sizes[0] - 4000) < 150
    again = S.random_split(rows.repartition(3), "id", [8.0, 1.0, 1.0], 42)
    for part, other in zip(parts, again):
        assert {r.id for r in part.collect()} == {r.id for r in other.collect()}
    assert {r.id for r in S.random_split(rows, "id", [8.0, 1.0, 1.0], 43)[1].collect()} != {r.id for r in parts[1].collect()}


def test_samples(spark):
    rows = spark.range(100)
    taken = [r.id for r in S.take_sample(rows, "id", 10, 1).collect()]
    assert len(set(taken)) == 10
    assert S.take_sample(rows, "id", 1000, 1).count() == 100
    more = [r.id for r in S.take_sample(rows, "id", 30, 1).collect()]
    assert len(set(more)) == 30 and set(taken) <= set(more) and S.take_sample(rows, "id", 0, 1).count() == 0
    drawn = S.take_sample_replace(rows, "id", 300, 1).collect()
    assert sorted(r.draw for r in drawn) == list(range(300))
    assert len({r.id for r in drawn}) < 100 and {r.id for r in drawn} <= set(range(100))


PAIRS = "user int, item int, rating double"


def test_rmse_join(spark):
    predicted = spark.createDataFrame([(1, 1, 5.0), (1, 2, 3.0), (1, 3, 4.0), (2, 1, 3.0), (2, 2, 2.0), (2, 3, 4.0)], PAIRS)
    actual = spark.createDataFrame([(1, 2, 3.0), (1, 3, 5.0), (2, 1, 5.0), (2, 2, 1.0)], PAIRS)
    second = spark.createDataFrame([(2, 2, 5.0), (1, 2, 5.0)], PAIRS)
    assert R.rmse_join(predicted, actual).first().rmse == pytest.approx(1.22474487139)
    assert R.rmse_join(second, actual).first().rmse == pytest.approx(3.16227766017)
    assert R.rmse_join(actual, actual).first().rmse == 0


@pytest.mark.parametrize("partitions", [1, 4])
def test_deterministic_sort(spark, partitions):
    rows = [(1.0, "alpha"), (2.0, "alpha"), (2.0, "beta"), (3.0, "alpha"), (1.0, "epsilon"), (1.0, "delta")]
    df = spark.createDataFrame(rows, "n double, s string").repartition(partitions)
    assert [tuple(r) for r in R.sort_deterministic(df, "n", "s").collect()] == sorted(rows)
    assert [tuple(r) for r in R.sort_deterministic(df, "n", "s", False).collect()] == sorted(rows, reverse=True)


def test_partition_functions(spark):
    letters = spark.createDataFrame([(c,) for c in "ABCD"], "s string").repartitionByRange(2, "s")

    def joined(batches):
        yield pd.DataFrame({"s": [",".join(x for b in batches for x in b["s"])]})

    def numbered(index, batches):
        yield pd.DataFrame({"part": [index], "s": [",".join(x for b in batches for x in b["s"])]})

    texts = [r.s for r in U.map_partitions(letters, joined, "s string").collect()]
    assert sorted(",".join(texts).strip(",").split(",")) == list("ABCD")
    rows = U.map_partitions_with_index(letters, numbered, "part int, s string").collect()
    assert len({r.part for r in rows}) == len(rows) == letters.rdd.getNumPartitions()


def test_custom_aggregate_equals_a_plain_sum(spark):
    def add(state, batch):
        return state + np.bincount(batch["bin"], minlength=5)

    def finish(state):
        return pd.DataFrame({"bin": range(5), "n": state})

    rows = spark.range(1000).select((F.col("id") % 4).cast("int").alias("bin")).repartition(7)
    result = U.custom_aggregate(rows, lambda: np.zeros(5, dtype="int64"), add, lambda a, b: a + b, finish, "bin int, n bigint")
    assert [tuple(r) for r in result.orderBy("bin").collect()] == [(0, 250), (1, 250), (2, 250), (3, 250), (4, 0)]


def test_failing_function_shows_at_the_action(spark):
    def fail(batches):
        raise RuntimeError("bad row")
        yield

    broken = U.map_partitions(spark.range(3), fail, "id bigint")
    with pytest.raises(Exception, match="bad row"):
        broken.collect()
