"""Joins that hold when one key has a third of the rows; adaptive execution is assumed on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from quern.session import stable

CELL_ROWS = 20_000


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def lookup_join(rows: DataFrame, lookup: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Joins rows to a table with about one row per key, whatever the size of either.

    Adaptive execution measures both sides: it broadcasts a lookup within the session's
    threshold and else cuts the partitions of frequent keys into several tasks, by position,
    so also where rows have nothing but the key. It can cut only what it shuffles itself:
    pass a stored lookup (``session.stable``), not an aggregation by the same key.
    """
    return rows.join(lookup, _keys(on), how)


def grid_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    left_spread: Column | str,
    right_spread: Column | str,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Inner join of two tables that both repeat keys.

    A key with n rows left and m rows right becomes a grid of about n/cell_rows by
    m/cell_rows cells; its rows are copied along the other side of the grid only. Every
    pair meets in exactly one cell and a cell never takes more than about ``cell_rows``
    rows from either side.
    """
    keys = _keys(on)
    n_left = left.groupBy(*keys).agg(F.count("*").alias("_n"))
    n_right = right.groupBy(*keys).agg(F.count("*").alias("_m"))
    sizes = stable(
        n_left.join(n_right, keys).select(
            *keys,
            F.ceil(F.col("_n") / cell_rows).cast("int").alias("_across"),
            F.ceil(F.col("_m") / cell_rows).cast("int").alias("_down"),
        )
    )
    return grid_join_sized(
        lookup_join(left, sizes, keys), lookup_join(right, sizes, keys), keys, left_spread, right_spread
    )


def grid_join_sized(
    left: DataFrame, right: DataFrame, on: Sequence[str], left_spread: Column | str, right_spread: Column | str
) -> DataFrame:
    """``grid_join`` of tables that carry the grid of their key in ``_across`` and ``_down``."""

    def placed(df: DataFrame, spread: Column | str, own: str, other: str) -> DataFrame:
        cell = F.pmod(F.xxhash64(spread), F.col(own)).cast("int")
        copies = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        return df.select("*", cell.alias(f"{own}_cell"), copies.alias(f"{other}_cell")).drop("_across", "_down")

    return placed(left, left_spread, "_across", "_down").join(
        placed(right, right_spread, "_down", "_across"), [*on, "_across_cell", "_down_cell"]
    ).drop("_across_cell", "_down_cell")


def left_join_default(left: DataFrame, right: DataFrame, on: str | Sequence[str], defaults: dict) -> DataFrame:
    """Keeps all left rows; columns the right side does not supply take their default."""
    joined = left.join(right, _keys(on), "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def not_in_list(df: DataFrame, key: str, values: Sequence) -> DataFrame:
    """Drops rows whose key is in a list the caller typed in."""
    return df.filter(~F.col(key).isin(list(values)))


def geocode_join(
    amounts: DataFrame,
    points: DataFrame,
    amount_key: str,
    number: str,
    street: str,
    upper_both: bool = True,
) -> DataFrame:
    """Matches places to ``NUMBER STREET`` of an address table; duplicate addresses multiply.

    ``upper_both=False`` leaves the case of the left key as it is. Sum amounts per place
    first: then no key repeats on the left side.
    """
    key = F.col(amount_key)
    left = amounts.withColumn("address", F.upper(key) if upper_both else key)
    right = points.withColumn("address", F.upper(F.concat_ws(" ", F.col(number).cast("string"), F.col(street))))
    return left.join(right, "address")
