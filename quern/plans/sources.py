"""Queries over readers and line parsers; lines are formatted from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quern.functions.text import STOP_WORDS, simple_tokenize
from quern.operators.aggregates import union_all
from quern.operators.rows import exploded
from quern.operators.text import drop_stop_words
from quern.plans.catalog import Tables, query
from quern.session import scratch_path
from quern.sources import parsers as P, readers as R


def time_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def clf_lines(t: Tables, broken: Column | None = None) -> DataFrame:
    """Access log lines from ``events``; lines where ``broken`` holds lose their quotes."""
    k = F.get_json_object("props", "$.k")
    code = F.when(F.col("event_type") == "error", "404").otherwise("200")
    size = F.when(F.col("event_type") == "view", "-").otherwise(F.floor(F.col("value") * 100).cast("string"))
    line = F.concat(
        F.lit("host"), F.col("user_id").cast("string"), F.lit(" - - ["),
        F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(' -0400] "GET /k/'), k, F.lit(' HTTP/1.0" '),
        code, F.lit(" "), size,
    )
    if broken is not None:
        line = F.when(broken, F.translate(line, '"', "")).otherwise(line)
    return t.events.select(line.alias("value"))


@query("SELECT unnest(string_split(text, chr(10))) AS line FROM documents")
def read_lines(t):
    path = scratch_path(t.spark, "lines")
    t.documents.select("text").write.text(path)
    return R.read_lines(t.spark, path).select(F.col("value").alias("line"))


@query("""
SELECT event_type AS action, json_extract_string(props, '$.k') AS obj_id, 'event' AS obj_type, count(*) AS n,
       CAST(min(epoch_us(ts)) // 1000 AS BIGINT) AS first_ms
FROM events GROUP BY ALL
""")
def parse_json_lines(t):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    record = F.struct(
        F.col("event_type").alias("action"),
        F.get_json_object("props", "$.k").alias("obj_id"),
        F.lit("event").alias("obj_type"),
        ms.alias("timestamp"),
    )
    lines = t.events.select(F.to_json(record).alias("value"))
    parsed = R.parse_json_lines(lines, "action string, obj_id string, obj_type string, timestamp bigint")
    return parsed.groupBy("action", "obj_id", "obj_type").agg(
        F.count("*").alias("n"), F.min("timestamp").alias("first_ms")
    )


@query("""
SELECT event_type, count(*) AS n, round(sum(value), 4) AS total, max(event_id) AS last_id
FROM events GROUP BY event_type
""")
def read_json_inferred(t):
    path = scratch_path(t.spark, "events-json")
    t.events.select("event_id", "event_type", "value").write.json(path)
    log = R.read_json_inferred(t.spark, path)
    return log.groupBy("event_type").agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"), F.max("event_id").alias("last_id")
    )


@query("""
SELECT o_orderstatus, o_orderpriority, CAST(year(o_orderdate) AS INT) AS y, count(*) AS n,
       sum(o_orderkey)::BIGINT AS keys, round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY ALL
""")
def read_csv_union(t):
    path = scratch_path(t.spark, "orders-csv")
    t.orders.repartition(3, "o_orderkey").write.csv(path, header=True)
    orders = R.read_csv_union(t.spark, path)
    return orders.groupBy("o_orderstatus", "o_orderpriority", F.year("o_orderdate").alias("y")).agg(
        F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


CLF_SQL = """
SELECT 'host' || user_id AS host, '-' AS client_identd, '-' AS user_id,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS date_time, 'GET' AS method,
       '/k/' || json_extract_string(props, '$.k') AS endpoint, 'HTTP/1.0' AS protocol,
       CASE WHEN event_type = 'error' THEN 404 ELSE 200 END AS response_code,
       CASE WHEN event_type = 'view' THEN 0 ELSE CAST(floor(value * 100) AS BIGINT) END AS content_size
FROM events
"""


@query(CLF_SQL)
def parse_clf(t):
    parsed = P.parse_clf(clf_lines(t)).filter("status = 1").drop("raw", "status")
    return parsed.withColumn("date_time", time_text(F.col("date_time")))


@query("""
SELECT count(*) AS read, count(*) FILTER (WHERE event_type <> 'signup') AS parsed,
       count(*) FILTER (WHERE event_type = 'signup') AS failed
FROM events
""")
def split_valid_invalid(t):
    return P.split_valid_invalid(P.parse_clf(clf_lines(t, F.col("event_type") == "signup")))[2]


@query("""
SELECT regexp_extract(line, '^host(\\d+)', 1)::BIGINT AS host, count(*) AS n
FROM (SELECT 'host' || user_id || ' - - ' AS line FROM events WHERE event_type = 'signup') GROUP BY host
""")
def quarantined_lines(t):
    bad = P.split_valid_invalid(P.parse_clf(clf_lines(t, F.col("event_type") == "signup")))[1]
    host = F.regexp_extract("raw", r"^host(\d+)", 1).cast("bigint")
    return bad.groupBy(host.alias("host")).agg(F.count("*").alias("n"))


@query("""
SELECT event_id,
       CASE WHEN ok THEN 'Mozilla/' || k || '.0' ELSE '' END AS browser_compatibility,
       CASE WHEN ok THEN 'X11; user ' || user_id ELSE '' END AS os_ver,
       CASE WHEN ok THEN 'AppleWebKit/537.36' ELSE '' END AS platform,
       CASE WHEN ok THEN 'KHTML, like Gecko' ELSE '' END AS browser_platform_details,
       CASE WHEN ok THEN 'Chrome/' || event_id ELSE '' END AS enhancement_1,
       CASE WHEN ok THEN 'Safari/537' ELSE '' END AS enhancement_2,
       ok::INT AS parse_ok
FROM (SELECT *, event_type <> 'error' AS ok, json_extract_string(props, '$.k') AS k FROM events)
""")
def parse_user_agent(t):
    agent = F.format_string(
        "Mozilla/%s.0 (X11; user %d) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/%d Safari/537",
        F.get_json_object("props", "$.k"), "user_id", "event_id",
    )
    agents = t.events.select("event_id", F.when(F.col("event_type") == "error", "curl/8").otherwise(agent).alias("ua"))
    parsed = P.parse_user_agent(agents, "ua")
    return parsed.select(
        "event_id",
        *[F.coalesce(c, F.lit("")).alias(c) for c in P.USER_AGENT_FIELDS],
        F.col("parse_ok").cast("int").alias("parse_ok"),
    )


@query("""
SELECT CASE WHEN p_size = 1 THEN '' ELSE p_partkey::VARCHAR END AS id,
       CASE WHEN p_size = 1 THEN '' ELSE p_name || ' "' || p_brand || ', ' || p_type || '" "' || p_type || '"' END AS product,
       CASE WHEN p_size = 1 THEN -1 ELSE 1 END AS status
FROM part UNION ALL SELECT '', '', 0
""")
def parse_quoted_product(t):
    line = F.format_string('"%d","%s","%s, %s","%s",%s', "p_partkey", "p_name", "p_brand", "p_type", "p_type",
                           F.col("p_retailprice").cast("string"))
    broken = F.translate(line, '"', "")
    lines = t.part.select(F.when(F.col("p_size") == 1, broken).otherwise(line).alias("value"))
    header = R.from_collection(t.spark, [('"id","title","description","manufacturer","price"',)], "value string")
    parsed = P.parse_quoted_product(union_all(lines, header))
    return parsed.select(
        F.coalesce("id", F.lit("")).alias("id"), F.coalesce("product", F.lit("")).alias("product"), "status"
    )


@query("""
SELECT source || ' ' || doc_id AS pair, 1 AS status FROM documents UNION ALL SELECT '', 0
""")
def parse_gold_mapping(t):
    lines = t.documents.select(F.format_string('"%s","%d"', "source", "doc_id").alias("value"))
    header = R.from_collection(t.spark, [('"id_a","id_b"',)], "value string")
    parsed = P.parse_gold_mapping(union_all(lines, header), header_key='"id_a"')
    return parsed.select(F.coalesce("pair", F.lit("")).alias("pair"), "status")


@query("""
SELECT status, "user", item, count(*) AS n, sum(rating) AS total FROM (
  SELECT CASE WHEN l_linenumber = 7 THEN -1 ELSE 1 END AS status,
         CASE WHEN l_linenumber <> 7 THEN l_suppkey + 3000000000 END AS "user",
         CASE WHEN l_linenumber <> 7 THEN l_partkey END AS item, CASE WHEN l_linenumber <> 7 THEN 1 + l_quantity % 5 END AS rating
  FROM lineitem) GROUP BY ALL
""")
def parse_ratings(t):
    """Some lines have no number for a rating; users are beyond 32 bits."""
    rating = F.when(F.col("l_linenumber") == 7, "good").otherwise((1 + F.col("l_quantity") % 5).cast("string"))
    line = F.concat_ws("::", F.col("l_suppkey") + F.lit(3_000_000_000), "l_partkey", rating, F.lit("0"))
    parsed = P.parse_ratings(t.lineitem.select(line.alias("value")))
    return parsed.groupBy("status", "user", "item").agg(F.count("*").alias("n"), F.sum("rating").alias("total"))


@query("""
SELECT CASE WHEN p_partkey % 10 = 0 THEN -1 ELSE 1 END AS status, CASE WHEN p_partkey % 10 <> 0 THEN p_partkey END AS item,
       CASE WHEN p_partkey % 10 <> 0 THEN p_name END AS title FROM part
""")
def parse_movies(t):
    key = F.when(F.col("p_partkey") % 10 == 0, "x").otherwise(F.col("p_partkey").cast("string"))
    line = F.concat_ws("::", key, "p_name", "p_type")
    return P.parse_movies(t.part.select(line.alias("value"))).drop("raw")


@query("""
SELECT CASE WHEN ok THEN 1 ELSE -1 END AS status, CASE WHEN ok THEN l_extendedprice END AS label,
       CASE WHEN ok THEN l_quantity END AS f0, CASE WHEN ok THEN l_discount END AS f1, CASE WHEN ok THEN l_tax END AS f2
FROM (SELECT *, l_linenumber <> 7 AS ok FROM lineitem)
""")
def parse_labeled_csv(t):
    names = ("l_extendedprice", "l_quantity", "l_discount")
    tax = F.when(F.col("l_linenumber") == 7, "?").otherwise(F.col("l_tax").cast("string"))
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in names], tax)
    parsed = P.parse_labeled_csv(t.lineitem.select(line.alias("value")))
    return parsed.select("status", "label", *[F.get("features", F.lit(i)).alias(f"f{i}") for i in range(3)])


@query("""
SELECT feature, value, count(*) AS n, sum(label) AS positives, (SELECT count(*) FROM lineitem WHERE l_linenumber = 7) AS bad
FROM (
  SELECT (l_linestatus = 'F')::DOUBLE AS label, unnest([0, 1, 2]) AS feature,
         unnest([CASE WHEN l_returnflag = 'N' THEN '' ELSE l_returnflag END,
                 l_linenumber::VARCHAR, l_suppkey::VARCHAR]) AS value
  FROM lineitem WHERE l_linenumber <> 7) GROUP BY feature, value
""")
def parse_ctr(t):
    flag = F.when(F.col("l_returnflag") == "N", "").otherwise(F.col("l_returnflag"))
    label = F.when(F.col("l_linenumber") == 7, "none").otherwise((F.col("l_linestatus") == "F").cast("int").cast("string"))
    line = F.concat_ws("\t", label, flag, "l_linenumber", "l_suppkey")
    parsed = P.parse_ctr(t.lineitem.select(line.alias("value")))
    bad = parsed.agg(F.count_if(F.col("status") == -1)).scalar()
    each = exploded(parsed, "label", f=F.col("features")).select("label", "f.feature", "f.value")
    counted = each.groupBy("feature", "value").agg(F.count("*").alias("n"), F.sum("label").alias("positives"))
    return counted.withColumn("bad", bad)


@query("""
SELECT status, CASE WHEN ok THEN vec_id END AS x, CASE WHEN ok THEN label::BIGINT END AS y,
       CASE WHEN ok THEN len(embedding)::INT END AS n, CASE WHEN ok THEN round(embedding[1]::DOUBLE, 6) END AS head,
       CASE WHEN ok THEN round(list_sum(embedding::DOUBLE[]), 6) END AS total
FROM (SELECT *, vec_id % 10 <> 0 AS ok, CASE WHEN vec_id % 10 = 0 THEN -1 ELSE 1 END AS status FROM embeddings)
""")
def parse_series(t):
    values = F.transform(F.col("embedding").cast("array<double>"), lambda v: v.cast("string"))
    head = F.when(F.col("vec_id") % 10 == 0, "row").otherwise(F.col("vec_id").cast("string"))
    line = F.concat_ws(" ", head, F.col("label").cast("string"), values)
    parsed = P.parse_series(t.embeddings.select(line.alias("value")))
    total = F.aggregate("ts", F.lit(0.0), lambda acc, v: acc + v)
    return parsed.select(
        "status", "x", "y", F.when(F.col("ts").isNotNull(), F.size("ts")).alias("n"),
        F.round(F.col("ts")[0], 6).alias("head"), F.round(total, 6).alias("total"),
    )


def sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# Non-empty tokens per document as (doc_id, token), and the same without stop words.
TOKENS_SQL = r"""
SELECT * FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '\W+')) AS token FROM documents)
WHERE token <> ''
"""
KEPT_TOKENS_SQL = f"{TOKENS_SQL} AND token NOT IN ({sql_list(STOP_WORDS)})"


@query(f"SELECT token, count(*) AS n FROM ({KEPT_TOKENS_SQL}) GROUP BY token")
def read_stopwords(t):
    path = scratch_path(t.spark, "stopwords")
    R.from_collection(t.spark, [(w,) for w in STOP_WORDS], "value string").coalesce(1).write.text(path)
    tokens = exploded(t.documents, token=simple_tokenize(F.col("text")))
    kept = drop_stop_words(tokens, R.read_stopwords(t.spark, path))
    return kept.groupBy("token").agg(F.count("*").alias("n"))


@query("""
SELECT event_type, count(*) AS n, sum(w)::BIGINT AS total
FROM events JOIN (VALUES ('click', 1), ('purchase', 5), ('signup', 3)) v(event_type, w) USING (event_type)
GROUP BY event_type
""")
def from_collection(t):
    weights = R.from_collection(t.spark, [("click", 1), ("purchase", 5), ("signup", 3)], "event_type string, w int")
    joined = t.events.join(F.broadcast(weights), "event_type")
    return joined.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("w").alias("total"))


@query("SELECT s_name, s_acctbal FROM supplier")
def select_columns(t):
    return t.supplier.select("s_name", "s_acctbal")
