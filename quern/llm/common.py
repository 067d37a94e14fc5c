"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator
from types import ModuleType

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quern.session import stable

__all__ = ["documents", "fresh", "give_back", "kept_in_worker", "let", "once", "sliced", "span_digest", "span_text", "stable", "with_arrow_column"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer name where the table has such a column already."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where the body names it in a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def once(value: Column) -> Column:
    """``value`` as a generated column, so that a filter on it is not pushed down as a second copy."""
    return F.explode(F.array(value))


def kept_in_worker(key: tuple, make: Callable):
    """``make()``, or what it gave an earlier task of the same worker process.

    Functions travel to workers by value, so the module of this one is no place to keep things.
    """
    state = sys.modules.setdefault("_quern_worker", ModuleType("_quern_worker")).__dict__
    if key not in state:
        state[key] = make()
    return state[key]


def give_back() -> None:
    """Returns free memory of this worker to the system, so that the next stage does not start on top of it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
    if trim is not None:
        trim(0)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that a task holds the Python objects of few rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
        give_back()


def with_arrow_column(
    df: DataFrame, source: str, name: str, kind: T.DataType, make: Callable[[], Callable[[list], pa.Array]]
) -> DataFrame:
    """Adds a column that Python computes from one other, batch by batch; a column of that name is replaced.

    ``make`` runs once per task and returns a function from a batch's values (a list, None
    for null) to an Arrow array of the same length. Batches are bounded in bytes by Spark.
    """
    kept = [c for c in df.columns if c.lower() != name.lower()]
    schema = T.StructType([*[df.schema[c] for c in kept], T.StructField(name, kind)])
    given = fresh(df, "_source")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in sliced(batches):
            values = fn(batch.column(len(kept)).to_pylist())
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(kept))], values], [*kept, name])

    return df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{source}`").alias(given)).mapInArrow(run, schema)


SPANS = "array<struct<kind:string,start:int,end:int>>"


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def span_digest(spans: Column) -> Column:
    return F.sha2(span_text(spans).cast("binary"), 256)
