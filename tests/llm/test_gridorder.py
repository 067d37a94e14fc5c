"""Epsilon grid order join against all pairs in plain Python, and odd inputs."""

import math
import random

import numpy as np
import pytest

from quern.llm import gridorder
from quern.llm.queries import QUERIES

from tests.llm.brute import components_of


def slow(rows, threshold=0.93):
    """``(vec_id, n_links, component_id, kept)`` of rows with unique ids, by every pair."""
    good = [
        (i, label, [float(x) for x in v])
        for i, v, label in rows
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    links = []
    for a, (i, p, x) in enumerate(good):
        for j, q, y in good[:a]:
            if p == q and len(x) == len(y):
                dot = sum(s * t for s, t in zip(x, y))
                if dot / (math.sqrt(sum(s * s for s in x)) * math.sqrt(sum(t * t for t in y))) >= threshold:
                    links.append((i, j))
    root = components_of([i for i, _, _ in rows], links)
    count = {i: 0 for i, _, _ in rows}
    for i, j in links:
        count[i] += 1
        count[j] += 1
    return sorted((i, count[i], root[i], root[i] == i) for i, _, _ in rows)


def test_query(spark, data):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{data}/embeddings.parquet").collect()]
    got = QUERIES["op13_embedding_near_dedup"](spark, data)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect())) == slow(rows)


@pytest.mark.parametrize("interval_rows, leaf_rows, dimensions", [(16, 5, 2), (64, 256, 3), (2048, 256, 6)])
def test_clouds_and_chains(spark, interval_rows, leaf_rows, dimensions):
    rng = np.random.default_rng(3)
    vectors = []
    for _ in range(12):
        v = rng.normal(size=8)
        for step in range(25):  # a chain: far ends do not link
            vectors.append(v.copy())
            v = v + rng.normal(size=8) * rng.choice([0.05, 0.3, 0.6])
    vectors += [vectors[0] * 3] * 40 + [rng.normal(size=8) for _ in range(60)]
    rows = [(i, [float(x) for x in v], f"label {i % 3}") for i, v in enumerate(vectors)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label string").repartition(5)
    got = gridorder.near_duplicates(df, interval_rows=interval_rows, leaf_rows=leaf_rows, dimensions=dimensions)
    assert sorted(map(tuple, got.collect())) == slow(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [1.0, 2.0, 2.0]
    rows = [
        (1, good, 1), (2, [2.0, 4.0, 4.0], 1), (3, good, None), (4, None, 1), (5, [], 1), (6, [0.0, 0.0, 0.0], 1),
        (7, [nan, 1.0, 1.0], 1), (8, [inf, 1.0, 1.0], 1), (9, [None, 2.0, 2.0], 1), (10, [1.0, 2.0], 1), (11, good, 2),
        (12, [1e300, 2e300, 2e300], 1), (13, [1.0, -0.0, 0.0], 5), (14, [1.0, 0.0, 0.0], 5),
    ]
    schema = "vec_id bigint, embedding array<double>, label int"
    df = spark.createDataFrame([(*r, r[0], "x") for r in rows], schema + ", n_links bigint, kept string")
    expected = {i: (0, i, True) for i, _, _ in rows}
    expected |= {1: (2, 1, True), 2: (2, 1, False), 12: (2, 1, False), 13: (1, 13, True), 14: (1, 13, False)}
    got = gridorder.near_duplicates(df).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == expected
    assert gridorder.near_duplicates(df.limit(0)).count() == 0
    assert gridorder.near_duplicates(df.filter("vec_id in (3, 4)")).count() == 2


def test_repeated_and_null_ids(spark):
    rows = [(None, [1.0, 0.0], 1), (7, [1.0, 0.1], 1), (7, [1.0, 0.1], 1), (4, [0.0, 1.0], 1), (None, [0.0, -1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = sorted(gridorder.near_duplicates(df).collect(), key=str)
    assert sorted(map(str, map(tuple, got))) == sorted(
        map(str, [(None, 2, 7, False), (7, 2, 7, True), (7, 2, 7, True), (4, 0, 4, True), (None, 0, None, True)])
    )


def test_threshold_is_met_exactly(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [0.6, 0.8], 1), (3, [-1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in gridorder.near_duplicates(df, threshold=0.6).collect()}
    assert got == {1: 1, 2: 1, 3: 0}
