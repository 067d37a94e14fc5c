"""Queries over the Column functions, one per function."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions import maths as M, text as X, times as D, vectors as V
from quern.functions.hashing import md5_bucket as _md5_bucket
from quern.operators.matrices import matrix_multiply as multiply
from quern.operators.rows import exploded
from quern.plans.catalog import query
from quern.plans.data import day_text, r, vectors
from quern.plans.sources import KEPT_TOKENS_SQL, TOKENS_SQL, clf_lines, time_text


@query("SELECT doc_id, trim(regexp_replace(lower(text), '[^a-z0-9 ]', '', 'g'), ' ') AS clean FROM documents")
def remove_punctuation(t):
    return t.documents.select("doc_id", X.remove_punctuation(F.col("text")).alias("clean"))


@query("""
SELECT doc_id, len(w)::INT AS parts, len(list_filter(w, lambda x: x = ''))::INT AS empty
FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents)
""")
def split_words(t):
    parts = t.documents.select("doc_id", X.split_words(F.col("text")).alias("w"))
    empty = F.size(F.filter("w", lambda x: x == ""))
    return parts.select("doc_id", F.size("w").alias("parts"), empty.alias("empty"))


@query(f"SELECT doc_id, token, count(*) AS n FROM ({TOKENS_SQL}) GROUP BY 1, 2")
def simple_tokenize(t):
    each = exploded(t.documents, "doc_id", token=X.simple_tokenize(F.col("text")))
    return each.groupBy("doc_id", "token").agg(F.count("*").alias("n"))


@query(f"SELECT doc_id, token, count(*) AS n FROM ({KEPT_TOKENS_SQL}) GROUP BY 1, 2")
def tokenize(t):
    each = exploded(t.documents, "doc_id", token=X.tokenize(F.col("text")))
    return each.groupBy("doc_id", "token").agg(F.count("*").alias("n"))


@query(r"""
SELECT doc_id, concat_ws(' ', CASE WHEN regexp_matches(text, 'License') THEN 'License' END,
       CASE WHEN regexp_matches(text, '[0-9]{3}\.[0-9]+\.') THEN '[0-9]{3}\.[0-9]+\.' END,
       CASE WHEN regexp_matches(text, '(?i)tion\b') THEN '(?i)tion\b' END) AS hits
FROM documents
""")
def match_any(t):
    patterns = ["License", r"[0-9]{3}\.[0-9]+\.", r"(?i)tion\b"]
    hits = F.array_join(X.match_any(F.col("text"), patterns), " ")
    return t.documents.select("doc_id", hits.alias("hits"))


@query("SELECT event_id, replace(props, '\"', '') AS plain FROM events")
def remove_quotes(t):
    return t.events.select("event_id", X.remove_quotes(F.col("props")).alias("plain"))


@query("SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS seen, count(*) AS n FROM events GROUP BY 1")
def parse_apache_time(t):
    stamp = F.regexp_extract("value", r"\[(.*)\]", 1)
    seen = clf_lines(t).select(D.parse_apache_time(stamp).alias("seen"))
    return seen.groupBy(time_text(F.col("seen")).alias("seen")).agg(F.count("*").alias("n"))


@query("""
SELECT size, count(*) AS n FROM (
 SELECT CASE WHEN event_type = 'view' THEN 0 ELSE floor(value * 100)::BIGINT END AS size FROM events) GROUP BY 1
""")
def dash_to_zero(t):
    size = F.regexp_extract("value", r"(\S+)$", 1)
    return clf_lines(t).select(D.dash_to_zero(size).alias("size")).groupBy("size").agg(F.count("*").alias("n"))


@query("SELECT event_id, hour(ts)::INT AS hour, isodow(ts)::INT AS weekday FROM events")
def epoch_ms_parts(t):
    ms = t.events.select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    return ms.select(
        "event_id", D.epoch_ms_hour(F.col("ms")).alias("hour"), D.epoch_ms_weekday(F.col("ms")).alias("weekday")
    )


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def yyyymmdd_to_date(t):
    ymd = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("ymd"))
    return ymd.select("o_orderkey", day_text(D.yyyymmdd_to_date(F.col("ymd"))).alias("day"))


@query("""
SELECT o_orderkey, (isodow(o_orderdate) < 6)::INT AS weekday,
       strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month FROM orders
""")
def is_weekday(t):
    day = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey", D.is_weekday(day).cast("int").alias("weekday"), day_text(D.month_floor(day)).alias("month")
    )


@query("SELECT c_custkey || ' ' || c_name AS pair, c_name || ': ' || c_nationkey AS line FROM customer")
def format_concat(t):
    return t.customer.select(
        X.pair_key(F.col("c_custkey"), F.col("c_name")).alias("pair"),
        X.key_value_line(F.col("c_name"), F.col("c_nationkey")).alias("line"),
    )


@query("SELECT doc_id, (quality - toxic) * (quality - toxic) AS err FROM labels")
def squared_error(t):
    return t.labels.select("doc_id", M.squared_error(F.col("quality"), F.col("toxic")).alias("err"))


@query("""
SELECT event_id, round(1 / (1 + exp(-greatest(least((value - 20) / 2, 20), -20))), 12) AS p FROM events
""")
def sigmoid_clipped(t):
    return t.events.select("event_id", r(M.sigmoid_clipped((F.col("value") - 20) / 2), 12).alias("p"))


@query("""
WITH s AS (SELECT doc_id, quality AS y, CASE doc_id % 4 WHEN 0 THEN 0.0::DOUBLE WHEN 1 THEN 1.0 WHEN 2 THEN 0.5 ELSE 0.9 END AS p
           FROM labels),
     e AS (SELECT doc_id, y, CASE WHEN p = 0 THEN 1e-11::DOUBLE WHEN p = 1 THEN 1 - 1e-11::DOUBLE ELSE p END AS p FROM s)
SELECT doc_id, round(CASE WHEN y = 1 THEN -ln(p) ELSE -ln(1 - p) END, 9) + 0.0 AS loss FROM e
""")
def log_loss(t):
    k = F.col("doc_id") % 4
    p = F.when(k == 0, 0.0).when(k == 1, 1.0).when(k == 2, 0.5).otherwise(0.9)
    return t.labels.select("doc_id", r(M.log_loss(p, F.col("quality")), 9).alias("loss"))


@query("SELECT o_orderkey, round(ln(o_totalprice), 9) AS log_price FROM orders")
def log_amount(t):
    return t.orders.select("o_orderkey", r(M.log_amount(F.col("o_totalprice")), 9).alias("log_price"))


E = "embedding::DOUBLE[]"


def positions(t, vector, digits: int = 9):
    """Rows ``vec_id, pos, x`` of a vector computed from ``v``."""
    return vectors(t).select("vec_id", F.posexplode(vector).alias("pos", "x")).withColumn("x", r("x", digits))


def positions_sql(vector: str, digits: int = 9, source: str = "embeddings") -> str:
    return f"""
SELECT vec_id, (generate_subscripts(x, 1) - 1)::INT AS pos, round(unnest(x), {digits}) + 0.0 AS x
FROM (SELECT vec_id, {vector} AS x FROM {source})
"""


@query(positions_sql(f"list_transform({E}, lambda x: x * 3)"))
def vec_scale(t):
    return positions(t, V.vec_scale(F.col("v"), 3.0))


@query(positions_sql(f"list_transform(list_zip({E}, list_reverse({E})), lambda p: p[1] * p[2])"))
def vec_mul(t):
    return positions(t, V.vec_mul(F.col("v"), F.reverse("v")))


@query(f"""
SELECT vec_id, round(list_dot_product({E}, {E}), 9) AS norm2,
       round(list_dot_product({E}, list_reverse({E})), 9) + 0.0 AS folded FROM embeddings
""")
def vec_dot(t):
    v = F.col("v")
    return vectors(t).select(
        "vec_id", r(V.vec_dot(v, v), 9).alias("norm2"), r(V.vec_dot(v, F.reverse(v)), 9).alias("folded")
    )


@query(f"SELECT vec_id, round(list_sum(({E})[62:64]), 9) + 0.0 AS total, 3 AS n FROM embeddings")
def vec_slice(t):
    last = vectors(t).select("vec_id", V.vec_slice(F.col("v"), 3).alias("s"))
    return last.select("vec_id", r(V.array_sum(F.col("s")), 9).alias("total"), F.size("s").alias("n"))


@query(positions_sql(f"({E}) || [1, 2, 3]::DOUBLE[]"))
def vec_concat(t):
    return positions(t, V.vec_concat(F.col("v"), V.literal_vector([1, 2, 3])))


# Series are shifted by 1, so that no mean is close to 0.
SHIFTED = "list_transform(embedding::DOUBLE[], lambda x: x + 1)"


@query(positions_sql(
    "list_transform(s, lambda x: (x - m) / m)", 8,
    f"(SELECT vec_id, {SHIFTED} AS s, list_avg({SHIFTED}) AS m FROM embeddings)",
))
def rescale_series(t):
    return positions(t, V.rescale_series(F.transform("v", lambda x: x + 1)), 8)


@query("""
SELECT vec_id, ((i - 1) % 8)::INT AS pos, round(sum(embedding[i]::DOUBLE), 8) + 0.0 AS total
FROM embeddings, range(1, 65) g(i) GROUP BY 1, 2
""")
def fold_by_period(t):
    folded = vectors(t).select("vec_id", F.posexplode(V.fold_by_period(F.col("v"), 8)).alias("pos", "total"))
    return folded.withColumn("total", r("total", 8))


@query("""
SELECT vec_id, ((i - 1) // 8)::INT AS pos, round(sum(embedding[i]::DOUBLE), 8) + 0.0 AS total
FROM embeddings, range(1, 65) g(i) GROUP BY 1, 2
""")
def fold_by_block(t):
    folded = vectors(t).select("vec_id", F.posexplode(V.fold_by_block(F.col("v"), 8)).alias("pos", "total"))
    return folded.withColumn("total", r("total", 8))


# A matrix over the whole vectors: cell (i, j) is ((7 i + 3 j) mod 5 - 2) / 2.
@query(positions_sql(
    "list_transform(range(4), lambda i: list_sum(list_transform(range(64), lambda j: v[j + 1] * ((7 * i + 3 * j) % 5 - 2) / 2.0::DOUBLE)))",
    8, f"(SELECT vec_id, {E} AS v FROM embeddings)",
))
def apply_matrix(t):
    matrix = [[((7 * i + 3 * j) % 5 - 2) / 2 for j in range(64)] for i in range(4)]
    return positions(t, V.apply_matrix(F.col("v"), matrix), 8)


# Mean of each of the 64 + 64 * 64 features per label.
@query(f"""
SELECT label, pos, round(avg(x), 9) + 0.0 AS mean
FROM (SELECT label, generate_subscripts(w, 1)::INT - 1 AS pos, unnest(w) AS x
      FROM (SELECT label, v || flatten(list_transform(v, lambda a: list_transform(v, lambda b: a * b))) AS w
            FROM (SELECT label, {E} AS v FROM embeddings)))
GROUP BY label, pos
""")
def two_way_interactions(t):
    features = vectors(t).select("label", F.posexplode_outer(V.two_way_interactions(F.col("v"))).alias("pos", "x"))
    return features.groupBy("label", "pos").agg(r(F.avg("x"), 9).alias("mean"))


@query("""
SELECT vec_id, round(((u % (2 * pi())) + (2 * pi())) % (2 * pi()) / (2 * pi()), 8) AS phi,
       round(sqrt(a * a + b * b), 8) AS rho
FROM (SELECT vec_id, a, b, atan2(-a, -b) + pi() / 2 AS u
      FROM (SELECT vec_id, embedding[1]::DOUBLE AS a, embedding[2]::DOUBLE AS b FROM embeddings))
""")
def polar_coords(t):
    phi, rho = M.polar_coords(F.col("v")[0], F.col("v")[1])
    return vectors(t).select("vec_id", r(phi, 8).alias("phi"), r(rho, 8).alias("rho"))


def md5_bucket_sql(text: str, buckets: int) -> str:
    acc = "0"
    for k in range(4):
        acc = f"(({acc}) * 4294967296 + ('0x' || substr(md5({text}), {8 * k + 1}, 8))::BIGINT) % {buckets}"
    return f"({acc})::BIGINT"


@query(f"SELECT p_partkey, {md5_bucket_sql('p_name', 32768)} AS bucket FROM part")
def md5_bucket(t):
    return t.part.select("p_partkey", _md5_bucket(F.col("p_name"), 32768).alias("bucket"))


@query("""
WITH a AS (SELECT l_suppkey AS i, l_linenumber AS k, sum(l_quantity) AS v FROM lineitem GROUP BY 1, 2),
     b AS (SELECT l_linenumber AS k, year(l_shipdate)::INT AS j, count(*) AS v FROM lineitem GROUP BY 1, 2)
SELECT a.i, b.j, sum(a.v * b.v) AS v FROM a JOIN b USING (k) GROUP BY 1, 2
""")
def matrix_multiply(t):


    a = t.lineitem.groupBy(F.col("l_suppkey").alias("i"), F.col("l_linenumber").alias("j")).agg(
        F.sum("l_quantity").alias("v")
    )
    b = t.lineitem.groupBy(F.col("l_linenumber").alias("i"), F.year("l_shipdate").alias("j")).agg(
        F.count("*").cast("double").alias("v")
    )
    return multiply(a, b)
