"""Queries over grouped counts, time histograms and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions.times import hhmm_to_minute, is_weekday, iso_weekday, month_floor, yyyymmdd_to_date
from quern.operators import aggregates as A, ordering as O, stats as S
from quern.operators.rows import exploded
from quern.plans.catalog import query
from quern.plans.data import EVENT_POINTS_SQL, day_text, event_points, r, vectors
from quern.session import stable


@query("SELECT count(*) AS n FROM lineitem")
def count_rows(t):
    return t.lineitem.agg(F.count("*").alias("n"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def count_by_key(t):
    return A.count_by_key(t.events, "event_type")


@query("SELECT l_quantity AS value, count(*) AS n FROM lineitem GROUP BY 1")
def count_by_value(t):
    return A.count_by_key(t.lineitem, F.col("l_quantity").alias("value"))


@query("SELECT l_suppkey, sum(l_quantity) AS total FROM lineitem GROUP BY l_suppkey")
def sum_by_key(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("total"))


@query("SELECT o_orderpriority, round(avg(o_totalprice), 4) AS mean FROM orders GROUP BY 1")
def mean_by_key(t):
    return t.orders.groupBy("o_orderpriority").agg(r(F.avg("o_totalprice")).alias("mean"))


@query("SELECT l_partkey, count(l_quantity) AS n, round(avg(l_quantity), 4) AS mean FROM lineitem GROUP BY 1")
def count_mean_by_key(t):
    return A.count_mean_by_key(t.lineitem, "l_partkey", "l_quantity").withColumn("mean", r("mean"))


@query("""
WITH o AS (SELECT nullif(o_custkey % 50, 7) AS k, CASE WHEN o_custkey % 50 <> 3 THEN o_orderkey % 100 END AS v FROM orders),
n AS (SELECT *, (row_number() OVER (PARTITION BY k ORDER BY v) - 1) // 5 AS chunk FROM o WHERE v IS NOT NULL)
SELECT k, chunk, array_to_string(list_sort(list(v)), ',') AS orders FROM n GROUP BY ALL UNION ALL
SELECT k, 0, '' FROM o GROUP BY k HAVING count(v) = 0
""")
def collect_by_key(t):
    """Repeated values, a null key and a key with null values alone, in chunks of five."""
    group = F.col("o_custkey") % 50
    rows = t.orders.select(
        F.nullif(group, F.lit(7)).alias("k"), F.when(group != 3, F.col("o_orderkey") % 100).alias("v")
    )
    lists = O.collect_by_key(rows, "k", "v", chunk_rows=5)
    return lists.select("k", "chunk", F.array_join(F.col("values").cast("array<string>"), ",").alias("orders"))


@query("SELECT sum(l_orderkey)::BIGINT AS total FROM lineitem")
def reduce_sum(t):
    return t.lineitem.agg(F.sum("l_orderkey").alias("total"))


@query("SELECT l_linestatus, round(product(1 + l_tax / 100000000), 8) AS product FROM lineitem GROUP BY 1")
def reduce_product(t):
    return t.lineitem.groupBy("l_linestatus").agg(r(F.product(1 + F.col("l_tax") / 100000000), 8).alias("product"))


@query("""
SELECT min(s) AS min, max(s) AS max, (sum(s) // count(s))::BIGINT AS avg
FROM (SELECT floor(value * 100)::BIGINT AS s FROM events)
""")
def min_max_avg(t):
    return A.min_max_avg(t.events.select(F.floor(F.col("value") * 100).alias("size")), "size")


@query("SELECT round(avg(o_totalprice), 4) AS mean, round(median(o_totalprice), 4) AS median FROM orders")
def mean_median(t):
    return S.mean_median(t.orders, "o_totalprice").select(r("mean").alias("mean"), r("median").alias("median"))


@query("SELECT DISTINCT user_id, event_type FROM events")
def distinct_rows(t):
    return t.events.select("user_id", "event_type").distinct()


@query("SELECT count(DISTINCT user_id) AS uniques FROM events")
def count_distinct(t):
    return t.events.agg(F.count_distinct("user_id").alias("uniques"))


@query("SELECT strftime(ts, '%Y-%m-%d') AS key, count(DISTINCT user_id) AS uniques FROM events GROUP BY 1")
def count_distinct_by_key(t):
    return A.count_distinct_by_key(t.events, day_text("ts"), "user_id").orderBy("key")


@query("""
SELECT strftime(ts, '%Y-%m-%d') AS key, count(*) // count(DISTINCT user_id) AS avg_rows FROM events GROUP BY 1
""")
def avg_requests_per_host(t):
    return A.avg_rows_per_unique_by_key(t.events, day_text("ts"), "user_id").orderBy("key")


@query("""
SELECT event_type, count(*) AS n, round(count(*) / (SELECT count(*) FROM events), 6) AS fraction
FROM events GROUP BY 1
""")
def fraction_of_total(t):
    return A.fraction_of_total(t.events, "event_type").withColumn("fraction", r("fraction", 6))


@query(r"""
SELECT sum(n)::BIGINT AS total, count(*) AS uniques, round(sum(n) / count(*), 2) AS mean_count FROM (
 SELECT count(*) AS n FROM (SELECT unnest(regexp_split_to_array(lower(text), '\W+')) AS w FROM documents)
 WHERE w <> '' GROUP BY w)
""")
def mean_count_per_unique(t):
    from quern.functions.text import simple_tokenize

    words = exploded(t.documents, w=simple_tokenize(F.col("text")))
    return A.mean_count_per_unique(words, "w")


@query("SELECT hour(ts)::INT AS hour, count(*) AS n FROM events GROUP BY 1")
def hour_histogram(t):
    return A.histogram_by(t.events, F.hour("ts"), "hour")


@query("SELECT hour(ts)::INT AS hour, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1")
def hourly_errors(t):
    return A.histogram_by(t.events.filter("event_type = 'error'"), F.hour("ts"), "hour")


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1")
def daily_errors(t):
    return A.histogram_by(t.events.filter("event_type = 'error'"), day_text("ts"), "day")


@query("SELECT isodow(ts)::INT AS weekday, count(*) AS n FROM events GROUP BY 1")
def weekday_histogram(t):
    return A.histogram_by(t.events, iso_weekday(F.col("ts")), "weekday")


@query("""
SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1
""")
def daily_total(t):
    stamped = t.orders.select(F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("ymd"), "o_totalprice")
    day = yyyymmdd_to_date(F.col("ymd"))
    return stamped.groupBy(day_text(day).alias("day")).agg(r(F.sum("o_totalprice"), 2).alias("total"))


@query("""
SELECT CASE WHEN isodow(o_orderdate) < 6 THEN 'weekday' ELSE 'weekend' END AS daytype,
       round(avg(o_totalprice), 4) AS mean FROM orders GROUP BY 1
""")
def weekday_weekend_mean(t):
    daytype = F.when(is_weekday(F.col("o_orderdate")), "weekday").otherwise("weekend")
    return t.orders.groupBy(daytype.alias("daytype")).agg(r(F.avg("o_totalprice")).alias("mean"))


@query("""
SELECT printf('%02d:%02d', t // 100, t % 100) AS minute, round(avg(value), 8) AS mean
FROM (SELECT hour(ts) * 100 + user_id % 100 AS t, value FROM events) WHERE t % 100 < 60 GROUP BY 1
""")
def minute_of_day_mean(t):
    # user_id stands in for minutes, so that some times do not exist
    hhmm = (F.hour("ts") * 100 + F.col("user_id") % 100).cast("int")
    timed = t.events.select(hhmm_to_minute(hhmm).alias("minute"), "value").filter("minute is not null")
    return timed.groupBy("minute").agg(r(F.avg("value"), 8).alias("mean"))


@query("""
SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month, round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY 1
""")
def monthly_total(t):
    month = day_text(month_floor(F.col("o_orderdate")))
    return t.orders.groupBy(month.alias("month")).agg(r(F.sum("o_totalprice"), 2).alias("total"))


@query("""
SELECT least(floor((l_extendedprice - lo) / ((hi - lo) / 50)), 49)::INT AS bin, count(*) AS n
FROM lineitem, (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem) GROUP BY 1
""")
def histogram_fixed(t):
    return A.histogram_fixed(t.lineitem, "l_extendedprice", 50)


@query("""
SELECT (SELECT min(1::BIGINT << b) FROM range(40) g(b) WHERE (1::BIGINT << b) >= n) AS bucket, count(*) AS keys
FROM (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 UNION ALL
      SELECT l_linenumber, count(*) FROM lineitem GROUP BY 1) GROUP BY 1
""")
def histogram_pow2(t):
    parts, numbers = (A.count_by_key(t.lineitem, k).select("n") for k in ("l_partkey", "l_linenumber"))
    return A.histogram_pow2(parts.unionAll(numbers), "n")


@query("""
SELECT (i - 1)::INT AS pos, round(sum(embedding[i]::DOUBLE), 6) + 0.0 AS total
FROM embeddings, range(1, 65) g(i) GROUP BY 1
""")
def vector_sum(t):
    return S.vector_sum(vectors(t), "v").withColumn("total", r("total", 6))


@query("""
SELECT (i - 1)::INT AS pos, round(avg(embedding[i]::DOUBLE), 6) AS mean FROM embeddings, range(1, 65) g(i) GROUP BY 1
""")
def vector_mean(t):
    return S.vector_mean(vectors(t), "v").withColumn("mean", r("mean", 6))


@query("""
SELECT round(min(x), 6) AS min, round(max(x), 6) AS max FROM (SELECT unnest(embedding)::DOUBLE AS x FROM embeddings)
""")
def array_min_max(t):
    return S.array_min_max(vectors(t), "v").select(r("min", 6).alias("min"), r("max", 6).alias("max"))


@query("""
SELECT (i - 1)::INT AS i, (j - 1)::INT AS j, round(covar_pop(embedding[i]::DOUBLE, embedding[j]::DOUBLE), 8) AS cov
FROM embeddings, range(1, 65) a(i), range(1, 65) b(j) GROUP BY 1, 2
""")
def covariance_matrix(t):
    return S.covariance_matrix(vectors(t), "v").withColumn("cov", r("cov", 8))


@query(f"SELECT feature, count(DISTINCT value) AS categories FROM ({EVENT_POINTS_SQL}) GROUP BY feature")
def category_counts(t):
    return A.category_counts(event_points(t))


@query("""
SELECT round(avg(c_acctbal / 100), 6) AS longitude, round(avg(c_acctbal / 200), 6) AS latitude FROM customer
""")
def geo_centroid(t):
    points = t.customer.select((F.col("c_acctbal") / 100).alias("x"), (F.col("c_acctbal") / 200).alias("y"))
    return points.agg(r(F.avg("x"), 6).alias("longitude"), r(F.avg("y"), 6).alias("latitude"))


WELCH_SQL = """
WITH s AS (SELECT isodow(o_orderdate) < 6 AS wd, count(*) AS n, avg(o_totalprice) AS m, var_samp(o_totalprice) AS v
           FROM orders GROUP BY 1),
     a AS (SELECT * FROM s WHERE NOT wd), b AS (SELECT * FROM s WHERE wd)
SELECT (a.m - b.m) / sqrt(a.v / a.n + b.v / b.n) AS t,
       (a.v / a.n + b.v / b.n) ** 2 / ((a.v / a.n) ** 2 / (a.n - 1) + (b.v / b.n) ** 2 / (b.n - 1)) AS df
FROM a, b
"""


@query(f"SELECT round(t, 6) AS t, round(df, 4) AS df FROM ({WELCH_SQL})")
def welch_t_test(t):
    daytype = t.orders.select(is_weekday(F.col("o_orderdate")).alias("weekday"), "o_totalprice")
    return S.welch_t_test(daytype, "weekday", "o_totalprice").select(r("t", 6).alias("t"), r("df", 4).alias("df"))


# The density of Student's t integrated from 0 to |t| by Simpson's rule.
@query(f"""
WITH w AS ({WELCH_SQL}),
     x AS (SELECT df, abs(t) / 20000 AS h, i, abs(t) * i / 20000 AS x FROM w, range(20001) g(i)),
     f AS (SELECT sum(h / 3 * (CASE WHEN i IN (0, 20000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
                      * (1 + x * x / df) ** (-(df + 1) / 2)) AS area FROM x)
SELECT round(1 - 2 * area * exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(df * pi()), 6) AS p FROM w, f
""")
def welch_p_value(t):
    daytype = t.orders.select(is_weekday(F.col("o_orderdate")).alias("weekday"), "o_totalprice")
    return S.welch_t_test(daytype, "weekday", "o_totalprice").select(r("p", 6).alias("p"))


@query("""
WITH p AS (SELECT n_chars AS score, quality FROM labels JOIN documents USING (doc_id)),
     g AS (SELECT score, sum(quality) AS pos, count(*) - sum(quality) AS neg FROM p GROUP BY score)
SELECT score, (sum(pos) OVER w)::BIGINT AS tp, (sum(neg) OVER w)::BIGINT AS fp,
       round((sum(pos) OVER w) / (SELECT sum(quality) FROM p), 6) AS tpr,
       round((sum(neg) OVER w) / (SELECT count(*) - sum(quality) FROM p), 6) AS fpr
FROM g WINDOW w AS (ORDER BY score DESC)
""")
def roc_curve(t):
    scored = t.labels.select("doc_id", "quality").join(t.documents.select("doc_id", "n_chars"), "doc_id")
    curve = S.roc_curve(scored, "n_chars", "quality")
    return curve.withColumns({"tpr": r("tpr", 6), "fpr": r("fpr", 6)})


# Prices hardly repeat: 50 points at equal steps of rank, and how much area they leave open.
@query("""
WITH p AS (SELECT l_extendedprice AS score, (l_returnflag = 'R')::INT AS truth FROM lineitem),
     o AS (SELECT score, row_number() OVER (ORDER BY score) - 1 AS r, count(*) OVER () AS n FROM p),
     c AS (SELECT DISTINCT score FROM o, range(50) g(i) WHERE r = i * n // 50),
     g AS (SELECT score, sum(truth) AS pos, count(*) - sum(truth) AS neg
           FROM (SELECT c.score, truth FROM p ASOF JOIN c ON p.score >= c.score) GROUP BY score),
     t AS (SELECT score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, pos, neg FROM g WINDOW w AS (ORDER BY score DESC)),
     a AS (SELECT sum(neg * (2 * tp - pos) / 2.0) AS area, sum(pos * neg / 2.0) AS error, sum(pos) AS p, sum(neg) AS n FROM t)
SELECT score, tp::BIGINT AS tp, fp::BIGINT AS fp, round(tp / a.p, 6) AS tpr, round(fp / a.n, 6) AS fpr,
       round(a.area / (a.p * a.n), 6) AS area, round(a.error / (a.p * a.n), 6) AS error
FROM t, a
""")
def roc_curve_binned(t):
    scored = t.lineitem.select("l_extendedprice", (F.col("l_returnflag") == "R").cast("int").alias("returned"))
    curve = stable(S.roc_curve(scored, "l_extendedprice", "returned", bins=50))
    area = S.roc_area(curve).first()
    rates = curve.withColumns({"tpr": r("tpr", 6), "fpr": r("fpr", 6)})
    return rates.withColumns({"area": r(F.lit(area.area), 6), "error": r(F.lit(area.error), 6)})


@query("""
WITH g AS (SELECT CASE WHEN isodow(l_shipdate) < 6 THEN 'weekday' ELSE 'weekend' END AS daytype, p_name,
                  round(sum(l_extendedprice), 2) AS total
           FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
SELECT daytype, p_name, total, rank::INT AS rank FROM (
 SELECT *, row_number() OVER (PARTITION BY daytype ORDER BY total DESC, p_name) AS rank FROM g) WHERE rank <= 10
""")
def top_k_per_group(t):
    daytype = F.when(is_weekday(F.col("l_shipdate")), "weekday").otherwise("weekend")
    per_part = t.lineitem.groupBy(daytype.alias("daytype"), F.col("l_partkey").alias("p_partkey")).agg(
        F.sum("l_extendedprice").alias("price")
    )
    named = per_part.join(t.part.select("p_partkey", "p_name"), "p_partkey")
    totals = named.groupBy("daytype", "p_name").agg(r(F.sum("price"), 2).alias("total"))
    return A.top_k_per_group(totals, "daytype", "p_name", "total", 10)
