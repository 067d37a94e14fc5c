"""Exact top-k inner products of integer vectors by MaxScore.

Dimensions are query terms and blocks of rows are shards. In a shard every term has bounds
on what it can add to a query's score; terms are taken from the largest bound down. The
first are essential: their postings are traversed for all rows. The others are probed only
for rows that can still reach the query's threshold, the k-th best score known so far; a
pilot of few rows gives each query its first one. The shards' lists are merged per query.

Defined results: vectors that are null, or hold null or non-finite components, and rows
with a null id take no part, neither as queries nor as candidates; components that a vector
lacks count as zero; a query's own row is every row with its id; repeated rows are
candidates each; ties go to the smaller id; an empty table gives no rows. Components are
expected to keep sums below 2**53.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from quern.llm.common import stable

SHARD_ROWS = 8192
QUERY_ROWS = 8192
PILOT_ROWS, PILOT_QUERIES = 1024, 512


def scaled(vector: Column, by: int = 64) -> Column:
    """``floor(by * x)`` of each component; null where the vector takes no part."""
    bad = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    )
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * by))
    return F.when(vector.isNotNull() & ~bad, whole)


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Rows of one list of lists, shorter vectors filled with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    values = values[column.offsets.to_numpy()[0] : column.offsets.to_numpy()[-1]]
    result = np.zeros((len(lengths), width))
    if len(values):
        row = np.repeat(np.arange(len(lengths)), lengths)
        result[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return result


def max_score(
    query: np.ndarray, postings: np.ndarray, low: np.ndarray, high: np.ndarray, own: np.ndarray, k: int,
    known: float = -np.inf, step: int = 8,
) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a shard that may be among the query's best k, and their scores; no such row is missed.

    ``postings[d]`` are the shard's values in dimension d, between ``low[d]`` and ``high[d]``.
    ``known`` is a score that k rows reach already; rows in ``own`` are left out.
    """
    top = np.maximum(query * low, query * high)
    spread = top - np.minimum(query * low, query * high)
    terms = np.argsort(-spread, kind="stable")
    # the most that the terms after the first i can add
    rest = np.concatenate([np.cumsum(top[terms][::-1])[::-1], [0.0]])
    alive, score = np.arange(postings.shape[1]), np.zeros(postings.shape[1])
    score[own] = -np.inf
    threshold = known
    for i in range(0, len(terms), step):
        part = terms[i : i + step]
        score = score + query[part] @ (postings[part] if len(alive) == postings.shape[1] else postings[np.ix_(part, alive)])
        left = terms[i + step :]
        if not len(left) or len(alive) <= k:
            continue
        if i == 0:
            # the k best so far, scored in full, give a first threshold
            best = np.argpartition(-score, k - 1)[:k]
            full = score[best] + query[left] @ postings[np.ix_(left, alive[best])]
            threshold = max(threshold, full.min())
        stay = score + rest[i + step] >= threshold
        if not stay.all():
            alive, score = alive[stay], score[stay]
    reach = (score >= threshold) & (score > -np.inf)
    return alive[reach], score[reach]


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                q_ids, known = batch.column(0)[i].values.to_numpy(), batch.column(1)[i].values.to_numpy()
                ids = batch.column(3)[i].values.to_numpy()
                q_list, rows = batch.column(2)[i].values, batch.column(4)[i].values
                width = max(
                    [1, *np.diff(q_list.offsets.to_numpy()).tolist(), *np.diff(rows.offsets.to_numpy()).tolist()]
                )
                queries, postings = _matrix(q_list, width), np.ascontiguousarray(_matrix(rows, width).T)
                low, high = postings.min(1), postings.max(1)
                order = np.argsort(ids, kind="stable")
                found = [(np.empty(0, np.int64),) * 3]
                for q_id, q, least in zip(q_ids, queries, known):
                    if np.maximum(q * low, q * high).sum() < least:
                        continue
                    a, b = np.searchsorted(ids, q_id, "left", sorter=order), np.searchsorted(ids, q_id, "right", sorter=order)
                    at, score = max_score(q, postings, low, high, order[a:b], k, least)
                    best = np.lexsort((ids[at], -score))[:k]
                    found.append((np.full(len(best), q_id), ids[at[best]], score[best].astype(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in zip(*found)], ["query_id", "vec_id", "score"]
                )

    return run


def _bounds(rows: Column) -> Column:
    """Largest and smallest component by dimension of the vectors of some rows; a missing one is 0."""
    lists = F.transform(rows, lambda r: r["v"])
    width = F.array_max(F.transform(lists, F.size))

    def side(pick) -> Column:
        return F.transform(
            F.sequence(F.lit(1), width), lambda d: pick(F.transform(lists, lambda v: F.coalesce(F.get(v, d - 1), F.lit(0).cast("bigint"))))
        )

    return F.struct(side(F.array_min).alias("low"), side(F.array_max).alias("high"))


def _reach(a: Column, b: Column) -> Column:
    """The most that the inner product of a vector within one pair of bounds and one within another can be."""

    def corner(i: Column) -> Column:
        low, high, other_low, other_high = (F.get(c[side], i) for c in (a, b) for side in ("low", "high"))
        return F.greatest(low * other_low, low * other_high, high * other_low, high * other_high)

    width = F.greatest(F.size(a["low"]), F.size(b["low"]))
    corners = F.transform(F.sequence(F.lit(0), width - 1), corner)
    return F.aggregate(corners, F.lit(0).cast("bigint"), lambda s, c: s + F.coalesce(c, F.lit(0)))


def top_k(
    vectors: DataFrame, queries: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "vector",
    shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS, pilot_rows: int = PILOT_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's best k; ``queries`` says which rows are queries.

    Rows are dealt to shards, and queries to blocks, by a hash of their id. A pilot of about
    ``pilot_rows`` rows gives every query a score that k rows reach already. A block then meets
    the shards whose bounds let one of its queries reach that score, as one row that holds
    both; a shard returns at most k rows for a query.
    """
    rows = stable(
        vectors.select(F.col(vec_id).cast("bigint").alias("id"), F.col(vector).alias("v"), queries.alias("q"))
        .filter("id is not null and v is not null")
    )
    n, m = rows.agg(F.count("*"), F.count_if("q")).first()
    shards, blocks, pilots = (max(1, -(-a // b)) for a, b in ((n, shard_rows), (m, query_rows), (n, pilot_rows)))

    def number(name: str, parts: int) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(name)), F.lit(parts)).cast("int").alias(name)

    def dealt(df: DataFrame, name: str, parts: int, *more: str) -> DataFrame:
        both = df.select(number(name, parts), F.struct("id", "v", *more).alias("r"))
        return both.groupBy(name).agg(F.collect_list("r").alias(f"{name}_rows"))

    def each(n: int, name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)

    def found(pairs: DataFrame, side: str) -> DataFrame:
        lists = [F.col(f"block_rows.{c}") for c in ("id", "known", "v")] + [F.col(f"{side}_rows.{c}") for c in ("id", "v")]
        names = ["q_id", "known", "q", "id", "v"]
        return pairs.select(*[x.alias(n) for x, n in zip(lists, names)]).mapInArrow(_search(k), "query_id bigint, vec_id bigint, score bigint")

    asked = rows.filter("q").withColumn("known", F.lit(float("-inf")))
    small = max(1, -(-m // PILOT_QUERIES))
    pilot = dealt(rows.filter(number("pilot", pilots) == 0), "pilot", 1).select(each(small, "block"), "pilot_rows")
    first = stable(found(dealt(asked, "block", small, "known").join(pilot, "block"), "pilot").distinct())
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = first.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") == k)
    known = kth.select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("known"))
    asked = rows.filter("q").join(stable(known), "id", "left").na.fill(float("-inf"), ["known"])

    left, right = stable(dealt(asked, "block", blocks, "known")), stable(dealt(rows, "shard", shards))
    least = F.array_min(F.transform("block_rows", lambda r: r["known"]))
    tops = left.select("block", least.alias("least"), _bounds(F.col("block_rows")).alias("a")).select("*", each(shards, "shard"))
    bounds = right.select("shard", _bounds(F.col("shard_rows")).alias("b"))
    meet = tops.join(bounds, "shard").filter(_reach(F.col("a"), F.col("b")) >= F.col("least")).select("block", "shard")
    pairs = stable(meet).join(left, "block").join(right, "shard")
    best = found(pairs, "shard").withColumn("rank", F.row_number().over(order))
    return best.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", scaled(F.col("embedding")).alias("vector"))
    return top_k(vectors, F.coalesce(F.col("vec_id") % 20 == 0, F.lit(False)))


OP5_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
      FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
