"""Queries over one-hot and hashed features, splits, samples and user functions."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from quern.operators import features as C, logistic as L, recommend as R, regression as G, sampling as S, udfs as U
from quern.operators.rows import exploded
from quern.plans.catalog import query
from quern.plans.data import (
    EVENT_POINTS_SQL, POINTS_SQL, RATINGS_SQL, event_points, points, r, ratings, titles,
)
from quern.plans.scalars import md5_bucket_sql

DICT_SQL = f"""
SELECT feature, value, row_number() OVER (ORDER BY feature, value) - 1 AS idx
FROM (SELECT DISTINCT feature, value FROM ({EVENT_POINTS_SQL}))
"""


@query(DICT_SQL)
def one_hot_dict(t):
    return C.one_hot_dict(event_points(t))


def _encoded(t):
    p = event_points(t)
    return C.one_hot_encode(p, C.one_hot_dict(p), "event_id")


@query(f"""
SELECT event_id, any_value(label) AS label, string_agg(idx::VARCHAR, ',' ORDER BY idx) AS idx
FROM ({EVENT_POINTS_SQL}) JOIN ({DICT_SQL}) USING (feature, value) GROUP BY event_id
""")
def one_hot_encode(t):
    return _encoded(t).withColumn("idx", F.array_join(F.col("idx").cast("array<string>"), ","))


BUCKETS = 2**15
HASHED_SQL = f"""
SELECT event_id, {md5_bucket_sql("(value || feature)", BUCKETS)} AS bucket, count(*)::DOUBLE AS n
FROM (SELECT DISTINCT event_id, value || feature AS s, value, feature FROM ({EVENT_POINTS_SQL})) GROUP BY 1, 2
"""


def _hashed(t):
    return event_points(t).select("event_id", "label", C.hash_features(F.col("features"), BUCKETS).alias("hashed"))


@query(HASHED_SQL)
def hash_features(t):
    each = exploded(_hashed(t), "event_id", e=F.map_entries("hashed"))
    return each.select("event_id", F.col("e.key").alias("bucket"), F.col("e.value").alias("n"))


@query(f"""
SELECT 'one-hot' AS encoding, round(3.0 / (SELECT count(*) FROM ({DICT_SQL})), 9) AS sparsity UNION ALL
SELECT 'hashed', round(avg(n) / {BUCKETS}, 9) FROM (SELECT event_id, count(*) AS n FROM ({HASHED_SQL}) GROUP BY 1)
""")
def sparsity(t):
    pairs = exploded(event_points(t), f=F.col("features"))
    width = pairs.agg(F.count_distinct("f.feature", "f.value")).scalar()
    one_hot = C.sparsity(_encoded(t), F.size("idx"), width)
    hashed = C.sparsity(_hashed(t), F.size("hashed"), BUCKETS)
    both = one_hot.withColumn("encoding", F.lit("one-hot")).unionByName(hashed.withColumn("encoding", F.lit("hashed")))
    return both.withColumn("sparsity", r("sparsity", 9))


WEIGHT_SQL = f"SELECT idx, ((idx * 37) % 11 - 5) / 10.0::DOUBLE AS w FROM ({DICT_SQL})"
PROBA_SQL = f"""
SELECT event_id, any_value(label) AS label, 1 / (1 + exp(-(sum(w) + 0.25))) AS p
FROM ({EVENT_POINTS_SQL}) JOIN ({DICT_SQL}) USING (feature, value) JOIN ({WEIGHT_SQL}) USING (idx) GROUP BY event_id
"""


def _probabilities(t):
    p = event_points(t)
    dictionary = C.one_hot_dict(p)
    weights = dictionary.select("idx", (((F.col("idx") * 37) % 11 - 5) / F.lit(10.0)).alias("w"))
    return C.predict_proba(C.one_hot_encode(p, dictionary, "event_id"), weights, 0.25, "event_id")


@query(f"SELECT event_id, round(p, 9) AS p FROM ({PROBA_SQL})")
def predict_proba(t):
    return _probabilities(t).select("event_id", r("p", 9).alias("p"))


@query(f"SELECT round(avg(CASE WHEN label = 1 THEN -ln(p) ELSE -ln(1 - p) END), 9) AS log_loss FROM ({PROBA_SQL})")
def evaluate_log_loss(t):
    return L.evaluate_log_loss(_probabilities(t)).withColumn("log_loss", r("log_loss", 9))


# --- splits and samples

def unit_hash_sql(key: str, seed: int) -> str:
    return f"('0x' || substr(md5({key} || ':{seed}'), 1, 8))::BIGINT / 4294967296.0::DOUBLE"


def split_sql(key: str, table: str, seed: int = 42) -> str:
    """Every row of a table with ``split`` 0, 1 or 2 for weights .8, .1, .1."""
    u = unit_hash_sql(key, seed)
    return f"SELECT *, CASE WHEN u < 0.8 THEN 0 WHEN u < 0.9 THEN 1 ELSE 2 END AS split FROM (SELECT *, {u} AS u FROM {table})"


WEIGHTS = [8.0, 1.0, 1.0]


@query(f"SELECT o_orderkey, split FROM ({split_sql('o_orderkey', 'orders')})")
def random_split(t):
    return S.with_split(t.orders.select("o_orderkey"), "o_orderkey", WEIGHTS, 42)


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY md5(o_orderkey || ':7'), o_orderkey LIMIT 100")
def take_sample(t):
    return S.take_sample(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey", 100, 7)


@query(f"""
SELECT draw, o_orderkey FROM
 (SELECT i AS draw, floor({unit_hash_sql("i", 7)} * (SELECT count(*) FROM orders))::BIGINT AS pos FROM range(500) g(i))
 JOIN (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM orders) USING (pos)
""")
def take_sample_replace(t):
    return S.take_sample_replace(t.orders.select("o_orderkey"), "o_orderkey", 500, 7).select("draw", "o_orderkey")


# --- errors and baselines

@query(f"""
SELECT round(sqrt(avg((a.rating - p.rating) ** 2)), 9) AS rmse
FROM ({RATINGS_SQL}) a JOIN (SELECT l_suppkey AS "user", l_partkey AS item, avg(l_linenumber) AS rating
                             FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2) p USING ("user", item)
""")
def rmse_join(t):
    late = t.lineitem.filter("l_returnflag = 'R'")
    predicted = late.groupBy(F.col("l_suppkey").alias("user"), F.col("l_partkey").alias("item")).agg(
        F.avg("l_linenumber").alias("prediction")
    )
    return R.rmse_join(predicted, ratings(t)).withColumn("rmse", r("rmse", 9))


@query("SELECT round(sqrt(avg((quality - toxic) ** 2)), 9) AS rmse FROM labels")
def rmse(t):
    return G.rmse(t.labels, "quality", "toxic").withColumn("rmse", r("rmse", 9))


@query(f"""
WITH s AS ({split_sql('o_orderkey', 'orders')}), m AS (SELECT avg(o_totalprice) AS mean FROM s WHERE split = 0)
SELECT split::VARCHAR AS part, round(sqrt(avg((o_totalprice - mean) ** 2)), 4) AS rmse FROM s, m GROUP BY split
""")
def mean_baseline(t):
    parts = S.random_split(t.orders, "o_orderkey", WEIGHTS, 42)
    scored = G.mean_baseline(parts[0], {str(i): p for i, p in enumerate(parts)}, "o_totalprice")
    return scored.withColumn("rmse", r("rmse"))


@query(f"""
WITH s AS ({split_sql('doc_id', 'labels')}), m AS (SELECT avg(quality) AS p FROM s WHERE split = 0)
SELECT split::VARCHAR AS part, round(avg(CASE WHEN quality = 1 THEN -ln(p) ELSE -ln(1 - p) END), 9) AS log_loss
FROM s, m GROUP BY split
""")
def log_loss_baseline(t):
    parts = S.random_split(t.labels, "doc_id", WEIGHTS, 42)
    scored = L.log_loss_baseline(parts[0], {str(i): p for i, p in enumerate(parts)}, "quality")
    return scored.withColumn("log_loss", r("log_loss", 9))


@query(f"""
SELECT mean, p_name || ' ' || item AS title, n FROM (SELECT item, count(rating) AS n, round(avg(rating), 6) AS mean FROM ({RATINGS_SQL}) GROUP BY 1)
JOIN part ON item = p_partkey WHERE n > 20 ORDER BY round(mean, 3) DESC, title DESC, n LIMIT 20
""")
def top_rated(t):
    # several parts share a name: the number is part of the title, so that the order is total
    return R.top_rated(ratings(t), _unique_titles(t), 20, 20).withColumn("mean", r("mean", 6))


def _unique_titles(t):
    return titles(t).withColumn("title", F.concat_ws(" ", "title", "item"))


# --- linear models with given weights

WEIGHTS_4 = [1.5, -0.5, 0.25, 2.0]
DOT_SQL = "(1.5 * f0 - 0.5 * f1 + 0.25 * f2 + 2.0 * f3)"


@query(f"SELECT l_orderkey, round(label, 9) AS label, round({DOT_SQL}, 9) AS prediction FROM ({POINTS_SQL})")
def linreg_predict(t):
    model = G.LinearModel(np.array(WEIGHTS_4))
    return points(t).select(
        "l_orderkey", r("label", 9).alias("label"), r(model.predict(F.col("features")), 9).alias("prediction")
    )


@query(f"""
SELECT pos, round(sum(x), 4) AS total FROM (
 SELECT unnest([0, 1, 2, 3]) AS pos, unnest([e * f0, e * f1, e * f2, e * f3]) AS x
 FROM (SELECT *, {DOT_SQL} - label AS e FROM ({POINTS_SQL}))) GROUP BY pos
""")
def gradient_summand(t):
    return G.gradient(points(t), WEIGHTS_4).withColumn("total", r("total"))


# --- user functions

@query("SELECT p_partkey, p_name || '/' || p_size AS tag FROM part")
def scalar_udf(t):
    @F.pandas_udf("string")
    def tag(name: pd.Series, size: pd.Series) -> pd.Series:
        return name + "/" + size.astype(str)

    return t.part.select("p_partkey", tag("p_name", "p_size").alias("tag"))


@query("SELECT word, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) GROUP BY word")
def table_udf(t):
    @F.arrow_udtf(returnType="word string")
    class Words:
        """Batches of rows in, batches of words out."""

        def eval(self, batch: pa.RecordBatch):
            yield pa.table({"word": pc.list_flatten(pc.split_pattern(batch.column("p_name"), " "))})

    return Words(t.part.select("p_name").asTable()).groupBy("word").agg(F.count("*").alias("n"))


def _zero():
    return np.zeros(64, dtype="int64")


def _add(state, batch):
    cents = (batch["value"].to_numpy() * 100).round().astype("int64")
    return state + np.bincount(np.minimum(cents // 1000, 63), minlength=64)


def _merge(a, b):
    return a + b


def _finish(state):
    bins = np.flatnonzero(state)
    return pd.DataFrame({"bin": bins.astype("int32"), "n": state[bins]})


@query("SELECT least(round(value * 100)::BIGINT // 1000, 63)::INT AS bin, count(*) AS n FROM events GROUP BY 1")
def custom_aggregate(t):
    return U.custom_aggregate(t.events.select("value"), _zero, _add, _merge, _finish, "bin int, n bigint")
