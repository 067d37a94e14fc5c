"""Training-data pipeline over ``documents``: each stage calls one operator of ``quern.llm``.

Null and empty texts are rejected by the first stage. Repeated rows are copies and leave
one. Every stage but the last keeps the columns of its input, also columns it does not know;
an empty table stays empty.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from quern.llm import language, packing, quality, secrets, simhash  # noqa: E402
from quern.llm.common import documents, fresh, stable  # noqa: E402
from quern.session import remove_scratch  # noqa: E402

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _names(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def _replaced(docs: DataFrame, text: Column, *drop: str) -> DataFrame:
    """The columns of ``docs`` with another text and its length."""
    changed = docs.withColumn("text", text)
    return changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).drop(*drop)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go; mixtures stay."""
    name = fresh(docs, "_language")
    found = language.predict(docs, language.train(language.learnable(docs)), out=name)
    return found.filter(F.col(f"{name}.lang_pred") != language.UNKNOWN).select(*_names(docs))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail go, and so do the bad lines of the others."""
    name = fresh(docs, "_quality")
    judged = quality.with_quality(docs, out=name).filter(F.col(f"{name}.kept"))
    return _replaced(judged, F.col(f"{name}.clean"), name).select(*_names(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints link, the one with the smallest id stays."""
    return simhash.deduplicated(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the texts; no document goes."""
    name = fresh(docs, "_secrets")
    found = secrets.find(docs, secrets.train(docs), out=name)
    return _replaced(found, secrets.redacted(F.col("text"), F.col(name)), name).select(*_names(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, with their sequence and place in it."""
    return packing.op10_digest(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("packing", pack),
]

#: Mixtures, fingerprints, chains of links and fitted models are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet and read again by the next."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = stable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


def write(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Writes the rows of ``run`` to a folder and removes the tables between the stages."""
    run(spark, sf_dir).write.parquet(path)
    remove_scratch(spark)
