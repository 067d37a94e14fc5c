"""Logistic regression on sparse 0/1 features, and log loss."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quern.functions.maths import log_loss
from quern.session import scratch_path, stable

INTERCEPT = -1  # its index among the weights


@dataclass
class LogisticModel:
    """Weights of a fit: a stored table ``idx, w`` of the features that training rows have; others weigh nothing."""

    table: DataFrame
    dimensions: int

    @property
    def intercept(self) -> float:
        return self.table.filter(F.col("idx") == INTERCEPT).select("w").first()[0]

    @property
    def weights(self) -> np.ndarray:
        """All weights in memory, for models small enough."""
        found = np.zeros(self.dimensions)
        for idx, w in self.weight_table().collect():
            found[idx] = w
        return found

    def weight_table(self, spark: SparkSession | None = None) -> DataFrame:
        return self.table.filter(F.col("idx") != INTERCEPT)


BLOCK = "block bigint, n int, labels binary, row binary, place binary, val binary, members array<bigint>"
BLOCK_ROWS, BLOCK_ENTRIES = 1 << 17, 1 << 20
BUCKET_ROWS = 1 << 19


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows ``label, idx, val`` packed some Arrow batches at a time, with the distinct features of each block.

    The intercept is a feature of every row. ``place`` says where an entry's feature stands
    among the members of its block, so that a step needs the weights of those only. The more
    rows a block has, the fewer members all blocks have together.
    """

    def packed(block: int, batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        label, idxs, vals = (pa.chunked_array([b.column(c) for b in batches]).combine_chunks() for c in range(3))
        n, lengths = len(label), idxs.value_lengths().to_numpy(zero_copy_only=False)
        idx = np.append(idxs.flatten().to_numpy(zero_copy_only=False), np.full(n, INTERCEPT))
        val = np.append(vals.flatten().to_numpy(zero_copy_only=False), np.ones(n))
        members, place = np.unique(idx, return_inverse=True)
        buffers = (
            label.to_numpy(zero_copy_only=False).astype("float64"),
            np.append(np.repeat(np.arange(n), lengths), np.arange(n)).astype("int32"),
            place.astype("int32"),
            val.astype("float64"),
        )
        cells = [pa.array([b.tobytes()], pa.binary()) for b in buffers]
        return pa.RecordBatch.from_arrays(
            [pa.array([block]), pa.array([n], pa.int32()), *cells, pa.array([members], pa.list_(pa.int64()))],
            ["block", "n", "labels", "row", "place", "val", "members"],
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 33
        held, n, entries = [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            n, entries = n + batch.num_rows, entries + len(batch.column(1).flatten())
            if n >= BLOCK_ROWS or entries >= BLOCK_ENTRIES:
                yield packed(block, held)
                block, held, n, entries = block + 1, [], 0, 0
        if held:
            yield packed(block, held)

    return rows.mapInArrow(pack, BLOCK)


@contextmanager
def _bucketed(blocks: DataFrame, buckets: int) -> Iterator[DataFrame]:
    """``blocks`` written once in buckets of ``block``, so that no join by it shuffles them."""
    spark, path = blocks.sparkSession, scratch_path(blocks.sparkSession, "blocks")
    name = f"blocks_{uuid.uuid4().hex}"
    dealt = blocks.repartition(buckets, "block")
    dealt.write.bucketBy(buckets, "block").option("path", path).saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")  # its files go with the other scratch tables


def _gradient(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gradient cells ``idx, g`` of blocks that come with the weights of their members, next to those weights."""
    for batch in batches:
        for i in range(batch.num_rows):
            n, members = batch.column(0)[i].as_py(), batch.column(5)[i].values.to_numpy()
            label, row, place, val = (
                np.frombuffer(batch.column(c)[i].as_buffer(), kind) for c, kind in ((1, "float64"), (2, "int32"), (3, "int32"), (4, "float64"))
            )
            w = np.zeros(len(members))
            w[np.searchsorted(members, batch.column(6)[i].values.to_numpy())] = batch.column(7)[i].values.to_numpy()
            raw = np.bincount(row, weights=w[place] * val, minlength=n)
            e = np.exp(-np.abs(raw))  # cannot overflow
            residual = np.where(raw >= 0, 1.0, e) / (1.0 + e) - label
            cells = np.bincount(place, weights=residual[row] * val, minlength=len(members))
            yield pa.record_batch({"idx": pa.array(members), "g": pa.array(cells), "w": pa.array(w)})


def logreg_sgd(
    train: DataFrame, dimensions: int, iterations: int = 50, step: float = 10.0, reg: float = 1e-6
) -> LogisticModel:
    """Full-batch gradient descent with L2 shrinkage and an intercept.

    Follows the update rule of Spark's ``LogisticRegressionWithSGD``. ``train`` has
    ``label`` and indices ``idx``, with ``val`` if entries are not all 1. Weights are a table:
    in a step each block of rows gets the weights of its own features by a join, and sums of
    gradient cells by feature give the next table, which is written. Blocks lie in buckets and
    stay where they are: a step moves weights and cells only. The driver and the tasks never
    hold all of a model.
    """
    val = F.col("val") if "val" in train.columns else F.transform("idx", lambda _: F.lit(1.0))
    rows = train.select(
        F.col("label").cast("double"), F.col("idx").cast("array<bigint>"), val.cast("array<double>").alias("val")
    )
    n = train.count()
    if not n:
        raise ValueError("no training rows")
    spread = min(train.sparkSession.sparkContext.defaultParallelism, -(-n // BLOCK_ROWS))
    buckets = max(spread, -(-n // BUCKET_ROWS))
    packed = ["n", "labels", "row", "place", "val", "members"]
    with _bucketed(_blocks(rows), buckets) as blocks:
        member = stable(blocks.select("block", F.explode("members").alias("idx")))
        first = F.when(F.col("idx") == INTERCEPT, 1.0).otherwise(0.0)
        table = stable(member.select("idx").distinct().withColumn("w", first))
        for i in range(1, iterations + 1):
            rate = step / float(np.sqrt(i))
            sent = member.join(table, "idx").repartition(buckets, "block").groupBy("block").agg(F.collect_list(F.struct("idx", "w")).alias("m"))
            met = blocks.join(sent, "block").select(*packed, F.col("m.idx").alias("idx"), F.col("m.w").alias("w"))
            cells = met.mapInArrow(_gradient, "idx bigint, g double, w double").groupBy("idx")
            new = F.any_value("w") * (1 - rate * reg) - F.sum("g") * (rate / n)
            table = stable(cells.agg(new.alias("w")))
    return LogisticModel(table, dimensions)


def evaluate_log_loss(df: DataFrame, p: str = "p", label: str = "label") -> DataFrame:
    return df.agg(F.avg(log_loss(F.col(p), F.col(label))).alias("log_loss"))


def log_loss_baseline(train: DataFrame, parts: dict[str, DataFrame], label: str) -> DataFrame:
    """Log loss on each part when the training share of positives is predicted everywhere."""
    share = train.agg(F.avg(label)).scalar()
    rows: DataFrame | None = None
    for name, df in parts.items():
        tagged = df.select(F.lit(name).alias("part"), F.col(label).alias("label"))
        rows = tagged if rows is None else rows.unionAll(tagged)
    loss: Column = log_loss(F.col("p"), F.col("label"))
    return rows.withColumn("p", share).groupBy("part").agg(F.avg(loss).alias("log_loss"))
