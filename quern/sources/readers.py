"""Text, JSON and CSV inputs."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from quern.session import stable


def read_lines(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """One row ``value`` per line.

    Plain text splits by itself; gzip files do not, so give ``min_partitions`` to spread
    their lines right after the read.
    """
    lines = spark.read.text(path, lineSep="\n")
    return lines.repartition(min_partitions) if min_partitions else lines


def parse_json_lines(lines: DataFrame, schema: T.StructType | str, col: str = "value") -> DataFrame:
    """Named fields of one JSON object per line; fields of lines that are no JSON are null."""
    return lines.select(F.from_json(F.col(col), schema, {"mode": "PERMISSIVE"}).alias("_j")).select("_j.*")


def read_json_inferred(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines as a table; with a declared ``schema`` that of the caller, else of the whole input.

    To infer it, the text is read and parsed once, into variants, which are written; their
    common schema is one aggregation over what was written. As with Spark's own inference
    numbers are whole or doubles, fields of several types are strings, fields come by name,
    and ``_corrupt_record`` holds the lines that are no JSON object, if there are any.
    """
    if schema is not None:
        return spark.read.schema(schema).json(path)
    parsed = read_lines(spark, path).filter(F.trim("value") != "").select("value", F.try_parse_json("value").alias("v"))
    good = F.coalesce(F.startswith(F.schema_of_variant("v"), F.lit("OBJECT")), F.lit(False))
    found = stable(parsed.select(F.when(good, F.col("v")).alias("v"), F.when(~good, F.col("value")).alias("_corrupt_record")))
    kind, bad = found.agg(F.schema_of_variant_agg("v"), F.count("_corrupt_record")).first()
    fields = T._parse_datatype_string(_struct_of(kind)).names if kind != "VOID" else []
    rows = found.select("_corrupt_record", F.try_variant_get("v", "$", _struct_of(kind)).alias("r")) if fields else found
    return rows.select(*(["_corrupt_record"] if bad else []), *[F.col("r").getField(f).alias(f) for f in fields])


_VARIANT_TYPES = re.compile(r"`(?:[^`]|``)*`|\b(OBJECT|VOID|VARIANT|DECIMAL\(\d+, ?\d+\))(?!\s*:)")


def _struct_of(variant: str) -> str:
    """The type of a table's rows for the common type of variants."""
    return _VARIANT_TYPES.sub(
        lambda m: m[0] if m[1] is None else {"OBJECT": "STRUCT", "VOID": "STRING", "VARIANT": "STRING"}.get(m[1], "DOUBLE"), variant
    )


def read_csv_union(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None) -> DataFrame:
    """All CSV files of a folder as one table with a header line.

    Types are those of a declared ``schema``, which reads the files once, or else taken from
    the data, which reads them twice.
    """
    if schema is not None:
        return spark.read.csv(path, header=True, schema=schema, enforceSchema=False)
    return spark.read.csv(path, header=True, inferSchema=True, enforceSchema=False)


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """Distinct words of a one-word-per-line file as column ``token``."""
    return read_lines(spark, path).select(F.col("value").alias("token")).distinct()


def from_collection(spark: SparkSession, rows: Sequence, schema: T.StructType | str) -> DataFrame:
    """Rows of the program as a table; meant for lists a caller types in."""
    return spark.createDataFrame(rows, schema)
