"""Global order without a single-task window: ranks, running totals, exact quantiles."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window as W, functions as F, types as T

from quern.session import stable

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def _in_order(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Rows range-partitioned and sorted, numbered within their partition, and written.

    Columns ``_part`` (ascending with the order) and ``_pos`` are added. The copy is
    written because range bounds are sampled: two runs may cut elsewhere.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = ordered.withColumn("_id", F.monotonically_increasing_id())
    return stable(
        numbered.withColumns(
            {
                "_part": F.shiftright("_id", _ROW_BITS),
                "_pos": F.col("_id").bitwiseAND(F.lit(2**_ROW_BITS - 1)),
            }
        ).drop("_id")
    )


def _offsets(ordered: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Totals of the partitions before each one; as many rows as there are partitions."""
    totals = ordered.groupBy("_part").agg(*[v.alias(k) for k, v in sums.items()])
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    return totals.select("_part", *[F.coalesce(F.sum(k).over(before), F.lit(0)).alias(k) for k in sums])


def zip_with_index(df: DataFrame, order: Sequence[Column | str], index: str = "index") -> DataFrame:
    """Numbers rows from 0 in the given order.

    End ``order`` with a unique column where keys repeat, so that one frequent key is
    cut over several partitions.
    """
    ordered = _in_order(df, order)
    offsets = _offsets(ordered, {"_before": F.count("*")})
    return (
        ordered.join(F.broadcast(offsets), "_part")
        .withColumn(index, F.col("_before") + F.col("_pos"))
        .drop("_part", "_pos", "_before")
    )


def running_totals(df: DataFrame, order: Sequence[Column | str], totals: dict[str, str]) -> DataFrame:
    """Adds running sums, ``{new column: summed column}``, over the whole order."""
    ordered = _in_order(df, order)
    offsets = _offsets(ordered, {f"_b_{k}": F.sum(v) for k, v in totals.items()})
    within = W.partitionBy("_part").orderBy("_pos").rowsBetween(W.unboundedPreceding, 0)
    summed = ordered.withColumns({k: F.sum(v).over(within) for k, v in totals.items()})
    joined = summed.join(F.broadcast(offsets), "_part")
    return joined.withColumns({k: F.col(k) + F.col(f"_b_{k}") for k in totals}).drop(
        "_part", "_pos", *[f"_b_{k}" for k in totals]
    )


def collect_by_key(df: DataFrame, key: str, value: str, chunk_rows: int = 100_000) -> DataFrame:
    """Sorted values of each key as rows ``key, chunk, values``, cut into lists of ``chunk_rows``.

    Chunks count from 0; all values are kept and no task holds more of a key than a chunk
    and its repeats. Null values are left out: a key that has no others, and null is a key
    like any other, has one empty list.
    """
    pairs = df.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("_n"))
    counted = running_totals(pairs, [key, value], {"_upto": "_n"})
    starts = counted.groupBy(F.col(key).alias("_key")).agg(F.min(F.col("_upto") - F.col("_n")).alias("_start"))
    placed = counted.join(stable(starts), F.col(key).eqNullSafe(F.col("_key"))).withColumns(
        {"_from": F.col("_upto") - F.col("_n") - F.col("_start"), "_to": F.col("_upto") - 1 - F.col("_start")}
    )
    # A repeated value may fill several chunks: one row for each chunk it reaches.
    pieces = placed.withColumn(
        "chunk", F.explode(F.sequence(F.floor(F.col("_from") / chunk_rows), F.floor(F.col("_to") / chunk_rows)))
    )
    low = F.greatest(F.col("_from"), F.col("chunk") * chunk_rows)
    high = F.least(F.col("_to"), F.col("chunk") * chunk_rows + chunk_rows - 1)
    copies = F.array_repeat(F.col(value), (high - low + 1).cast("int"))
    lists = (
        pieces.select(key, "chunk", copies.alias("_v"))
        .groupBy(key, "chunk")
        .agg(F.sort_array(F.flatten(F.collect_list("_v"))).alias("values"))
    )
    empty = df.groupBy(key).agg(F.count(value).alias("_n")).filter("_n = 0")
    none = F.array().cast(lists.schema["values"].dataType)
    return lists.unionByName(empty.select(key, F.lit(0).cast("bigint").alias("chunk"), none.alias("values")))


SKETCH_CELLS = 1000


def quantile_sketch(df: DataFrame, value: str, cells: int = SKETCH_CELLS, **also: Column) -> Row:
    """One scan: ``below, n, above, nan`` count values (minus infinity, finite, infinity, NaN), ``marks`` are quantiles.

    The mergeable summary behind Spark's approximate percentiles gives ``cells + 1`` finite
    values, each within a tenth of a cell of its rank. ``also`` adds aggregates to the scan.
    """
    v = F.col(value).cast(_number(df, value))
    inf = F.lit(float("inf"))
    finite = ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < inf)
    shares = F.expr(f"array({', '.join(f'{i / cells!r}D' for i in range(cells + 1))})")
    real = F.when(finite, v)
    return df.agg(
        F.count_if(v.cast("double") == -inf).alias("below"), F.count_if(finite).alias("n"),
        F.count_if(v.cast("double") == inf).alias("above"), F.count_if(F.isnan(v.cast("double"))).alias("nan"),
        F.percentile_approx(real, shares, F.lit(10 * cells)).alias("marks"), F.min(real).alias("low"), F.max(real).alias("high"),
        *[c.alias(k) for k, c in also.items()],
    ).first()


def _number(df: DataFrame, value: str) -> str:
    whole = isinstance(df.schema[value].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    return "bigint" if whole else "double"


def values_at_ranks(
    df: DataFrame, value: str, ranks: Sequence[int], cells: int = SKETCH_CELLS, sketch: Row | None = None
) -> list[float | int | None]:
    """The values at 0-based ranks, in two scans whatever the distribution.

    A sketch brackets each rank; the second scan counts the rows between brackets, and the
    rows of each value inside them, about three cells a rank. Running totals of those counts
    give the values, which are exact. Rows are never sorted or shuffled, so a frequent value
    is one count. Nulls are left out, NaN is the largest value, as in Spark's order, and a
    rank beyond the last value gives None.
    """
    seen = sketch or quantile_sketch(df, value, cells)
    found: dict[int, float | int | None] = {}
    for rank in set(ranks):
        beyond = rank - seen.below - seen.n
        if rank < seen.below:
            found[rank] = float("-inf")
        elif beyond >= 0:
            found[rank] = float("inf") if beyond < seen.above else float("nan") if beyond < seen.above + seen.nan else None
    slack = 1
    while left := sorted(set(ranks) - set(found)):
        marks = [seen.low, *seen.marks[1:-1], seen.high]
        brackets: list[list] = []
        for rank in left:
            cell = (rank - seen.below) * cells // seen.n
            low, high = marks[max(0, cell - slack)], marks[min(cells, cell + 1 + slack)]
            if brackets and low <= brackets[-1][1]:
                brackets[-1][1] = max(brackets[-1][1], high)
            else:
                brackets.append([low, high])
        found |= _inside(df, value, left, brackets, seen.below)
        slack *= 8  # only if the sketch broke its promise
    return [found[rank] for rank in ranks]


def _inside(df: DataFrame, value: str, ranks: Sequence[int], brackets: list[list], below: int) -> dict[int, float | int]:
    """The values of those ranks that lie in the brackets, by one scan of the finite values."""
    kind = _number(df, value)
    lows, highs = (np.array(x, "int64" if kind == "bigint" else "float64") for x in zip(*brackets))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        between = np.zeros(len(lows) + 1, np.int64)
        for batch in batches:
            v = batch.column(0).to_numpy(zero_copy_only=False)
            v = v[np.isfinite(v)]
            after = np.searchsorted(lows, v, "right")
            inside = (after > 0) & (v <= highs[after - 1])
            between += np.bincount(after[~inside], minlength=len(between))
            values, first, n = np.unique(v[inside], return_index=True, return_counts=True)
            yield pa.record_batch({"slot": pa.array(2 * after[inside][first] - 1, pa.int32()), "v": pa.array(values), "n": pa.array(n, pa.int64())})
        yield pa.record_batch(
            {"slot": pa.array(2 * np.arange(len(between)), pa.int32()), "v": pa.nulls(len(between), pa.from_numpy_dtype(lows.dtype)), "n": pa.array(between)}
        )

    rows = df.select(F.col(value).cast(kind).alias("v")).filter("v is not null")
    counts = rows.mapInArrow(count, f"slot int, v {kind}, n bigint").groupBy("slot", "v").agg(F.sum("n").alias("n"))
    totals = running_totals(counts.filter("n > 0"), ["slot", "v"], {"upto": "n"}).filter("v is not null")
    wanted = np.array(sorted(ranks)) - below

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, upto = (batch.column(c).to_numpy() for c in (1, 2))
            first, last = np.searchsorted(wanted, upto - n), np.searchsorted(wanted, upto)
            row = np.repeat(np.arange(len(n)), last - first)
            at = np.arange(len(row)) - np.repeat(np.cumsum(last - first) - last, last - first)
            yield pa.RecordBatch.from_arrays([pa.array(wanted[at]), batch.column(0).take(pa.array(row))], ["rank", "v"])

    hits = totals.select("v", "n", "upto").mapInArrow(pick, f"rank bigint, v {kind}")
    return {r.rank + below: r.v for r in hits.collect()}


def value_at_rank(df: DataFrame, value: str, rank: int, bins: int = SKETCH_CELLS) -> float | int | None:
    """The value at one rank, see :func:`values_at_ranks`; ``bins`` is the number of cells of the sketch."""
    return values_at_ranks(df, value, [rank], bins)[0]
