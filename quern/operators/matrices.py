"""Matrices as coordinate tables ``i, j, v`` with whole numbers ``i, j``; cells that are not listed are 0."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BLOCK = 512  # rows and columns of a block


def _blocks(cells: DataFrame, row: str, column: str, side: str, size: int) -> DataFrame:
    """One row per block that has a cell; a block holds at most ``size ** 2`` cells."""
    at = [F.floor(F.col(c) / size).alias(f"b{n}") for c, n in (("i", row), ("j", column))]
    inner = [F.pmod(F.col(c), F.lit(size)).cast("int").alias(c) for c in ("i", "j")]
    cell = F.struct(*inner, F.col("v").cast("double").alias("v"))
    found = cells.select(*at, cell.alias("c")).groupBy(f"b{row}", f"b{column}").agg(F.collect_list("c").alias("c"))
    return found.select(f"b{row}", f"b{column}", *[F.col(f"c.{c}").alias(f"{side}_{c}") for c in ("i", "j", "v")])


def matrix_multiply(a: DataFrame, b: DataFrame, size: int = BLOCK) -> DataFrame:
    """Product of two matrices, block by block; cells that no product reaches are not listed.

    The blocks that make up one block of the result travel to one task, which adds their
    products in memory: dense ones by a matrix product, sparse ones along their cells. Blocks
    are what is shuffled, never products of cells. Cells of one place are added up.
    """
    left, right = _blocks(a, "i", "k", "a", size), _blocks(b, "k", "j", "b", size)
    pairs = left.join(right, "bk").repartition("bi", "bj").sortWithinPartitions("bi", "bj")
    columns = ["bi", "bj", *[f"{side}_{c}" for side in "ab" for c in ("i", "j", "v")]]
    return pairs.select(*columns).mapInArrow(_products(size), "i bigint, j bigint, v double")


def _products(size: int):
    def dense(row: np.ndarray, column: np.ndarray, value: np.ndarray) -> np.ndarray:
        found = np.zeros((size, size))
        np.add.at(found, (row, column), value)
        return found

    def add(total: np.ndarray, reached: np.ndarray, a: list[np.ndarray], b: list[np.ndarray]) -> None:
        (a_i, a_k, a_v), (b_k, b_j, b_v) = a, b
        order = np.argsort(b_k, kind="stable")
        b_k, b_j, b_v = b_k[order], b_j[order], b_v[order]
        first = np.searchsorted(b_k, a_k, "left")
        count = np.searchsorted(b_k, a_k, "right") - first
        if count.sum() > size * size:
            total += (dense(a_i, a_k, a_v) @ dense(b_k, b_j, b_v)).ravel()
            reached |= (dense(a_i, a_k, np.ones(len(a_i))) @ dense(b_k, b_j, np.ones(len(b_k)))).ravel() > 0
            return
        of = np.repeat(np.arange(len(a_i)), count)
        at = np.arange(len(of)) + np.repeat(first - (np.cumsum(count) - count), count)
        place = a_i[of].astype(np.int64) * size + b_j[at]
        np.add.at(total, place, a_v[of] * b_v[at])
        reached[place] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, total, reached = None, np.zeros(size * size), np.zeros(size * size, bool)

        def listed() -> pa.RecordBatch:
            at = np.flatnonzero(reached)
            i, j = block[0] * size + at // size, block[1] * size + at % size
            return pa.record_batch({"i": pa.array(i), "j": pa.array(j), "v": pa.array(total[at])})

        for batch in batches:
            for r in range(batch.num_rows):
                own = (batch.column(0)[r].as_py(), batch.column(1)[r].as_py())
                if own != block:
                    if block is not None:
                        yield listed()
                    block = own
                    total[:], reached[:] = 0.0, False
                cells = [batch.column(c)[r].values.to_numpy(zero_copy_only=False) for c in range(2, 8)]
                add(total, reached, cells[:3], cells[3:])
        if block is not None:
            yield listed()

    return run


def transpose(a: DataFrame) -> DataFrame:
    return a.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")
