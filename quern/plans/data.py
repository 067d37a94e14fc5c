"""Inputs several queries share, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quern.operators.joins import lookup_join
from quern.operators.rows import exploded, once
from quern.plans.catalog import Tables
from quern.session import stable


def r(c: Column | str, digits: int = 4) -> Column:
    """Rounded, so that sums in another order print alike; adding 0 turns -0 to 0."""
    return F.round(c, digits) + F.lit(0.0)


def day_text(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def vectors(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))


def event_points(t: Tables) -> DataFrame:
    """Categorical points with the unique ``event_id``: weekday, k, user; errors are positive."""
    values = [F.weekday("ts").cast("string"), F.get_json_object("props", "$.k"), F.col("user_id").cast("string")]
    features = F.array(
        *[F.struct(F.lit(i).alias("feature"), v.alias("value")) for i, v in enumerate(values)]
    )
    return t.events.select(
        "event_id", (F.col("event_type") == "error").cast("double").alias("label"), features.alias("features")
    )


# The same points in SQL: event_id, label, feature, value.
EVENT_POINTS_SQL = """
SELECT event_id, (event_type = 'error')::DOUBLE AS label, unnest([0, 1, 2]) AS feature,
       unnest([(isodow(ts) - 1)::VARCHAR, json_extract_string(props, '$.k'), user_id::VARCHAR]) AS value
FROM events
"""


def ratings(t: Tables) -> DataFrame:
    """One rating per supplier ("user") and part ("item")."""
    return t.lineitem.groupBy(
        F.col("l_suppkey").cast("int").alias("user"), F.col("l_partkey").cast("int").alias("item")
    ).agg(F.avg(1 + F.col("l_quantity") % 5).alias("rating"))


RATINGS_SQL = """
SELECT l_suppkey AS "user", l_partkey AS item, avg(1 + l_quantity % 5) AS rating FROM lineitem GROUP BY 1, 2
"""


def titles(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").cast("int").alias("item"), F.col("p_name").alias("title"))


def points(t: Tables) -> DataFrame:
    """Regression rows: price against four line item columns scaled to about 0..1."""
    q, d, x = F.col("l_quantity") / 50, F.col("l_discount") * 10, F.col("l_tax") * 10
    return t.lineitem.select(
        "l_orderkey",
        (F.col("l_extendedprice") / 1000).alias("label"),
        F.array(q, d, x, (F.col("l_linenumber") / 7).cast("double")).alias("features"),
    )


POINTS_SQL = """
SELECT l_orderkey, l_extendedprice / 1000 AS label, l_quantity / 50 AS f0, l_discount * 10 AS f1, l_tax * 10 AS f2,
       l_linenumber / 7 AS f3
FROM lineitem
"""


GRAM = 4  # words in a key at most


def contained_items(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Pairs ``item_id, doc_id`` where the document has the item's text, found by word runs.

    Words inside the item are whole words of any document that has it, so a run of up to
    ``GRAM`` of them is an equality key; only documents that share it are searched for the
    text. Items of one or two words have no inside: all their words must be whole.
    """
    words = F.split("text", " ", -1)
    inner = F.size(words) - 2
    length = F.when(inner > 0, F.least(inner, F.lit(GRAM))).otherwise(F.size(words))
    key = F.slice(words, F.when(inner > 0, 2).otherwise(1), length)

    def run_at(hashed: Column, i: Column | int, n: int) -> Column:
        """Hash of ``n`` words from place i by the hashes of each; places beyond the end do not count."""
        return F.xxhash64(*[F.get(hashed, i + k) for k in range(n)])

    keys = items.filter(F.col("text").isNotNull()).select(
        "item_id", F.col("text").alias("item"), run_at(F.transform(key, lambda w: F.xxhash64(w)), F.lit(0), GRAM).alias("run")
    )
    listed = documents.select("doc_id", once(F.transform(words, lambda w: F.xxhash64(w))).alias("_w"))
    used = [r[0] for r in items.select(length).distinct().collect() if r[0]]  # at most GRAM numbers

    def runs_of(n: int) -> Column:
        places = F.when(F.size("_w") >= n, F.sequence(F.lit(0), F.size("_w") - n)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: run_at(F.col("_w"), i, n))

    none = F.array().cast("array<bigint>")
    runs = exploded(listed, "doc_id", run=F.array_distinct(F.concat(none, *[runs_of(n) for n in used])))
    candidates = stable(lookup_join(runs, keys, "run").select("item_id", "item", "doc_id"))  # so that their number is known
    found = candidates.join(documents.select("doc_id", "text"), "doc_id").filter(F.contains("text", "item"))
    return found.select("item_id", "doc_id")
