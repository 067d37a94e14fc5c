"""Queries over projections, filters, joins, sorts and set operations."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Window as W, functions as F

from quern.operators import aggregates as A, joins as J, ordering as O, udfs as U
from quern.operators.recommend import sort_deterministic as _sort_deterministic
from quern.operators.regression import constant_prediction as _constant, shift_label as _shift_label
from quern.operators.rows import exploded
from quern.operators.text import drop_empty as _drop_empty
from quern.functions.vectors import series_std
from quern.plans.catalog import query
from quern.plans.data import day_text, r, vectors
from quern.session import stable


# --- projections and filters

@query("""
SELECT o_orderkey, o_orderkey - 1 AS previous, o_orderpriority || 's' AS plural, o_totalprice * 0.1::DOUBLE AS tenth
FROM orders
""")
def map_column(t):
    return t.orders.select(
        "o_orderkey",
        (F.col("o_orderkey") - 1).alias("previous"),
        F.concat("o_orderpriority", F.lit("s")).alias("plural"),
        (F.col("o_totalprice") * 0.1).alias("tenth"),
    )


@query("SELECT event_id, user_id, value FROM events WHERE event_type = 'error' AND value > 50 AND user_id < 100")
def filter_rows(t):
    errors = t.events.filter(F.col("event_type") == "error").filter(F.col("value") > 50)
    return errors.filter(F.col("user_id") < 100).select("event_id", "user_id", "value")


@query("SELECT sum(o_orderkey - 1)::BIGINT AS total, count(*) AS n FROM orders WHERE (o_orderkey - 1) % 2 = 0")
def map_filter_reduce(t):
    shifted = t.orders.select((F.col("o_orderkey") - 1).alias("x"))
    return shifted.filter(F.col("x") % 2 == 0).agg(F.sum("x").alias("total"), F.count("*").alias("n"))


@query("SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING count(*) > 10")
def having_min_count(t):
    return A.having_min_count(t.events, "user_id", 10)


@query("SELECT p_partkey, p_name FROM part WHERE p_brand NOT IN ('Brand#1', 'Brand#2', 'Brand#17')")
def not_in_list(t):
    return J.not_in_list(t.part, "p_brand", ["Brand#1", "Brand#2", "Brand#17"]).select("p_partkey", "p_name")


@query("""
SELECT doc_id, count(*) AS words
FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents) WHERE word <> '' GROUP BY doc_id
""")
def drop_empty(t):
    each = exploded(t.documents, "doc_id", word=F.split("text", " ", -1))
    return _drop_empty(each, "word").groupBy("doc_id").agg(F.count("*").alias("words"))


@query("""
SELECT vec_id FROM embeddings WHERE list_stddev_pop(embedding::DOUBLE[]) > 0.125
""")
def filter_by_series_std(t):
    return vectors(t).filter(series_std(F.col("v")) > 0.125).select("vec_id")


@query("SELECT o_custkey AS k, o_orderkey AS v FROM orders")
def swap_key_value(t):
    pairs = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("v"))
    return pairs.select(F.col("v").alias("k"), F.col("k").alias("v"))


@query("""
SELECT l_orderkey, x::INT AS x FROM (SELECT l_orderkey, unnest(range(1, l_linenumber)) AS x FROM lineitem)
""")
def flat_map(t):
    upto = F.when(F.col("l_linenumber") > 1, F.sequence(F.lit(1), F.col("l_linenumber") - 1))
    return exploded(t.lineitem, "l_orderkey", x=upto)


@query("""
SELECT word, count(*) AS n FROM (SELECT unnest([p_name, p_name || 's']) AS word FROM part) GROUP BY word
""")
def flat_map_plural(t):
    both = F.explode(F.array("p_name", F.concat("p_name", F.lit("s"))))
    return A.count_by_key(t.part.select(both.alias("word")), "word")


@query("SELECT o_custkey, o_totalprice / 1000 AS thousands FROM orders")
def map_values(t):
    return t.orders.select("o_custkey", (F.col("o_totalprice") / 1000).alias("thousands"))


@query("""
SELECT doc_id, line, row_number() OVER (ORDER BY doc_id, line_no) - 1 AS line_index
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
             unnest(range(len(string_split(text, chr(10))))) AS line_no FROM documents)
""")
def zip_with_index(t):
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    return O.zip_with_index(lines, ["doc_id", "line_no"], "line_index").drop("line_no")


@query("SELECT l_orderkey, (year(l_shipdate) - (SELECT min(year(l_shipdate)) FROM lineitem))::INT AS label FROM lineitem")
def shift_label(t):
    return _shift_label(t.lineitem.select("l_orderkey", F.year("l_shipdate").alias("label")), "label")


@query("SELECT o_orderkey, round((SELECT avg(o_totalprice) FROM orders), 4) AS prediction FROM orders")
def constant_prediction(t):
    mean = t.orders.agg(F.avg("o_totalprice")).scalar()
    return _constant(t.orders.select("o_orderkey"), F.round(mean, 4))


def _status_totals(batches):
    counts: dict[str, list] = {}
    for batch in batches:
        for status, total in batch.groupby("o_orderstatus")["o_custkey"].agg(["count", "sum"]).iterrows():
            held = counts.setdefault(status, [0, 0])
            held[0] += int(total["count"])
            held[1] += int(total["sum"])
    yield pd.DataFrame([(k, n, s) for k, (n, s) in counts.items()], columns=["o_orderstatus", "n", "keys"])


@query("SELECT o_orderstatus, count(*) AS n, sum(o_custkey)::BIGINT AS keys FROM orders GROUP BY o_orderstatus")
def map_partitions(t):
    parts = U.map_partitions(
        t.orders.select("o_orderstatus", "o_custkey"), _status_totals, "o_orderstatus string, n bigint, keys bigint"
    )
    return parts.groupBy("o_orderstatus").agg(F.sum("n").alias("n"), F.sum("keys").alias("keys"))


def _counted(index, batches):
    n = 0
    for batch in batches:
        yield pd.DataFrame({"o_orderkey": batch["o_orderkey"], "part": index, "pos": range(n, n + len(batch))})
        n += len(batch)


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS row FROM orders")
def map_partitions_with_index(t):
    """Numbers sorted rows: places within each partition, then what the partitions before it hold."""
    spread = t.orders.select("o_orderkey").repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey")
    placed = stable(U.map_partitions_with_index(spread, _counted, "o_orderkey bigint, part int, pos bigint"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # a row per partition
    counts = placed.groupBy("part").agg(F.count("*").alias("n"))
    offsets = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return placed.join(F.broadcast(offsets), "part").select("o_orderkey", (F.col("before") + F.col("pos")).alias("row"))


# --- joins

@query("""
SELECT c_mktsegment, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment
""")
def inner_join(t):
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    joined = J.lookup_join(t.orders.select("o_custkey", "o_totalprice"), customers, "o_custkey")
    return joined.groupBy("c_mktsegment").agg(F.count("*").alias("n"), r(F.sum("o_totalprice"), 2).alias("total"))


@query("""
SELECT a.l_partkey, a.l_suppkey, a.n, b.late FROM
 (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2) a JOIN
 (SELECT l_partkey, l_suppkey, count(*) AS late FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2) b
 USING (l_partkey, l_suppkey)
""")
def inner_join_composite(t):
    pair = ["l_partkey", "l_suppkey"]
    every = t.lineitem.groupBy(*pair).agg(F.count("*").alias("n"))
    late = t.lineitem.filter("l_returnflag = 'R'").groupBy(*pair).agg(F.count("*").alias("late"))
    return every.join(late, pair)


@query("""
SELECT p_name, s_name, n, round(q, 4) AS quantity FROM
 (SELECT l_partkey, l_suppkey, count(*) AS n, avg(l_quantity) AS q FROM lineitem GROUP BY 1, 2)
 JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
""")
def join_chain(t):
    counts = t.lineitem.groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("n"), F.avg("l_quantity").alias("q"))
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name")
    suppliers = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    named = J.lookup_join(J.lookup_join(counts, parts, "l_partkey"), suppliers, "l_suppkey")
    return named.select("p_name", "s_name", "n", r("q").alias("quantity"))


@query("""
SELECT c_custkey, coalesce(n, 0) AS n, coalesce(total, 0) AS total FROM customer LEFT JOIN
 (SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1) ON c_custkey = o_custkey
""")
def left_join_default(t):
    spent = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("n"), r(F.sum("o_totalprice"), 2).alias("total")
    )
    return J.left_join_default(t.customer.select("c_custkey"), spent, "c_custkey", {"n": 0, "total": 0.0})


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def anti_join(t):
    served = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return t.customer.select("c_custkey", "c_name").join(served, "c_custkey", "left_anti")


@query("""
SELECT r_name, count(*) AS n, round(sum(c_acctbal), 2) AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name
""")
def broadcast_lookup(t):
    nations = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("r_regionkey"))
    located = J.lookup_join(t.customer.select("c_nationkey", "c_acctbal"), nations, "c_nationkey")
    named = J.lookup_join(located, t.region, "r_regionkey")
    return named.groupBy("r_name").agg(F.count("*").alias("n"), r(F.sum("c_acctbal"), 2).alias("balance"))


@query("""
SELECT upper(place) AS address, amount, longitude, latitude FROM
 (SELECT s_nationkey || ' Nation_' || s_nationkey AS place, round(sum(s_acctbal), 2) AS amount FROM supplier GROUP BY 1)
 JOIN (SELECT c_custkey, c_nationkey || ' NATION_' || c_nationkey AS address,
              c_acctbal / 100 AS longitude, c_acctbal / 200 AS latitude FROM customer)
 ON upper(place) = address
""")
def geocode_join(t):
    place = F.concat(F.col("s_nationkey").cast("string"), F.lit(" Nation_"), F.col("s_nationkey").cast("string"))
    amounts = t.supplier.groupBy(place.alias("place")).agg(r(F.sum("s_acctbal"), 2).alias("amount"))
    points = t.customer.select(
        F.col("c_nationkey").alias("number"),
        F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")).alias("street"),
        (F.col("c_acctbal") / 100).alias("longitude"),
        (F.col("c_acctbal") / 200).alias("latitude"),
    )
    return J.geocode_join(amounts, points, "place", "number", "street").select(
        "address", "amount", "longitude", "latitude"
    )


# --- sorts, limits, top-k

@query("SELECT user_id, event_id, value FROM events ORDER BY user_id, event_id")
def sort_by_key(t):
    return t.events.select("user_id", "event_id", "value").orderBy("user_id", "event_id")


@query("SELECT p_name, p_partkey, round(p_retailprice, 3) AS price FROM part")
def sort_deterministic(t):
    ordered = _sort_deterministic(t.part, "p_retailprice", "p_name")
    return ordered.select("p_name", "p_partkey", F.round("p_retailprice", 3).alias("price"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def take_n(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(5)


@query("SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice, p_partkey LIMIT 5")
def bottom_k(t):
    return t.part.select("p_partkey", "p_retailprice").orderBy("p_retailprice", "p_partkey").limit(5)


@query("SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 5")
def top_k(t):
    return t.part.select("p_partkey", "p_retailprice").orderBy(F.desc("p_retailprice"), "p_partkey").limit(5)


ENDPOINT_SQL = "(SELECT json_extract_string(props, '$.k') AS endpoint, user_id, event_type FROM events)"


def _requests(t):
    return t.events.select(F.get_json_object("props", "$.k").alias("endpoint"), "user_id", "event_type")


@query(f"SELECT endpoint, count(*) AS n FROM {ENDPOINT_SQL} GROUP BY endpoint ORDER BY n DESC, endpoint LIMIT 10")
def top_k_by_count(t):
    return A.top_k_by_count(_requests(t), "endpoint", 10)


@query(f"""
SELECT endpoint, count(*) AS n FROM {ENDPOINT_SQL} WHERE event_type = 'error'
GROUP BY endpoint ORDER BY n DESC, endpoint LIMIT 20
""")
def top_error_endpoints(t):
    return A.top_k_by_count(_requests(t), "endpoint", 20, F.col("event_type") == "error")


@query(f"""
SELECT user_id, count(*) AS n FROM {ENDPOINT_SQL} WHERE event_type = 'error'
GROUP BY user_id ORDER BY n DESC, user_id LIMIT 25
""")
def top_error_hosts(t):
    return A.top_k_by_count(_requests(t), "user_id", 25, F.col("event_type") == "error")


@query("""
SELECT p_name, round(sum(l_extendedprice), 2) AS total FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY p_name ORDER BY total DESC, p_name LIMIT 10
""")
def top_k_by_sum(t):
    per_part = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.sum("l_extendedprice").alias("price"))
    named = per_part.join(t.part.select("p_partkey", "p_name"), "p_partkey")
    return A.top_k_by_sum(named, "p_name", "price", 10).withColumn("total", r("total", 2))


@query("""
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events WHERE event_type = 'error'
GROUP BY day ORDER BY n DESC, day LIMIT 5
""")
def top_days(t):
    per_day = A.histogram_by(t.events.filter("event_type = 'error'"), day_text("ts"), "day")
    return per_day.orderBy(F.desc("n"), "day").limit(5)


@query(f"SELECT DISTINCT endpoint FROM {ENDPOINT_SQL} WHERE event_type = 'error' ORDER BY endpoint LIMIT 40")
def pick_distinct(t):
    return _requests(t).filter("event_type = 'error'").select("endpoint").distinct().orderBy("endpoint").limit(40)


@query(r"""
SELECT doc_id, len(list_filter(regexp_split_to_array(lower(text), '\W+'), lambda x: x <> ''))::INT AS measure
FROM documents ORDER BY measure DESC, doc_id LIMIT 1
""")
def argmax_row(t):
    from quern.functions.text import simple_tokenize

    counted = t.documents.select("doc_id", F.size(simple_tokenize(F.col("text"))).alias("tokens"))
    return A.argmax_row(counted, F.col("tokens"), "doc_id").select("doc_id", "measure")


# --- set operations

@query("""
SELECT nation, count(*) AS n FROM (
 SELECT c_nationkey AS nation FROM customer UNION ALL SELECT s_nationkey FROM supplier) GROUP BY nation
""")
def union_all(t):
    customers = t.customer.select(F.col("c_nationkey").alias("nation"))
    suppliers = t.supplier.select(F.col("s_nationkey").alias("nation"))
    return A.count_by_key(A.union_all(customers, suppliers), "nation")
