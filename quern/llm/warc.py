"""WARC: revisit records answered "not modified" get the response they refer to.

An as-of join by canonical URL finds the latest earlier full response; it counts only if the
validators of both agree, and then its headers are updated by those that a not-modified
answer may change. Column expressions only.

Defined results: records without a URL or a date are answered for as ``no_response`` (revisits)
or never found (responses), records without a type are neither; a revisit without an HTTP
head counts as not modified, without validators, one with another status than 304 is not
answered for; of responses with one URL and date the larger id
counts; repeated header names are joined by commas; repeated revisits are resolved each on
their own; an empty table gives no rows; columns other than the raw record and those named
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from quern.llm.common import let, once, stable

#: Parameters that name a visit, not a page.
TRACKING = "utm_[a-z]+|fbclid|gclid|ref|sessionid"
#: Headers that describe the stored body or one connection; a not-modified answer leaves them (RFC 9111, 3.2).
KEPT = (
    "content-encoding content-length content-md5 content-range content-type "
    "connection keep-alive proxy-authenticate proxy-connection te trailer transfer-encoding upgrade"
).split()


def canonical_url(url: Column) -> Column:
    """Scheme and ``www.`` aside, lower-case host, no default port, tracking, fragment or final slash."""
    bare = F.regexp_replace(F.btrim(url), "#.*$", "")
    rest = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(rest, r"^[^/?]*", "")
    path = F.regexp_replace(path, rf"([?&])(({TRACKING})=[^&]*(&|$))+", "$1")
    return F.concat(host, F.regexp_replace(path, r"[?&/]+$", ""))


def headers(block: Column) -> Column:
    """Map of a header block by lower-case name; repeated names are joined by commas."""
    lines = F.filter(F.split(block, "\n", -1), lambda x: F.instr(x, ":") > 1)

    def entry(x: Column) -> Column:
        colon = F.instr(x, ":")
        return F.struct(
            F.lower(F.btrim(F.substring(x, F.lit(1), colon - 1))).alias("name"),
            F.btrim(F.substring(x, colon + 1, F.length(x))).alias("value"),
        )

    def as_map(entries: Column) -> Column:
        names = F.array_distinct(F.transform(entries, lambda e: e["name"]))

        def joined(n: Column) -> Column:
            return F.array_join(F.transform(F.filter(entries, lambda e: e["name"] == n), lambda e: e["value"]), ", ")

        repeats = F.map_from_arrays(names, F.transform(names, joined))
        return F.when(F.size(names) == F.size(entries), F.map_from_entries(entries)).otherwise(repeats)

    return let(F.filter(F.transform(lines, entry), lambda e: e["name"] != ""), as_map)


def parsed(raw: DataFrame, record: str = "record") -> DataFrame:
    """``record_id, type, url, date, status, http`` of raw records; nothing behind the two heads is looked at."""
    cut = F.substring_index(F.substring_index(F.col(f"`{record}`"), "\r\n\r\n", 2), "\n\n", 2)
    heads = F.split(F.replace(cut, F.lit("\r\n"), F.lit("\n")), "\n\n", 3)

    def fields(h: Column) -> Column:
        answer = F.get(h, F.lit(1))
        first = F.substring_index(answer, "\n", 1)
        return F.struct(
            headers(F.get(h, F.lit(0))).alias("warc"),
            F.regexp_extract(first, r"^HTTP/\S+ ([0-9]{3})", 1).try_cast("int").alias("status"),
            headers(F.substring(answer, F.length(first) + 1, F.length(answer))).alias("http"),
        )

    # generated columns: filters on what was parsed do not parse again
    parts = raw.select(once(let(heads, fields)).alias("r")).select("r.warc", "r.status", "r.http")
    warc = F.col("warc")
    return parts.select(
        warc["warc-record-id"].alias("record_id"),
        warc["warc-type"].alias("type"),
        warc["warc-target-uri"].alias("url"),
        F.try_to_timestamp(warc["warc-date"]).alias("date"),
        "status",
        "http",
    )


def _latest_before(rows: DataFrame) -> DataFrame:
    """Adds ``found``, the latest earlier response of the same URL, to revisits.

    Rows are range-partitioned by URL and date, so the rows of one URL may fill many
    partitions; the last response before a partition is carried in from a table with one
    row per partition.
    """
    order = ["url", "date", "is_revisit_first", "record_id"]
    response = F.when(F.col("type") == "response", F.struct("url", "record_id", "http"))
    sorted_rows = (
        rows.withColumn("is_revisit_first", (F.col("type") == "response").cast("int"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("id", F.monotonically_increasing_id())
    )
    placed = stable(sorted_rows.withColumn("part", F.shiftright("id", 33))).withColumn("response", response)
    last = placed.groupBy("part").agg(
        F.max_by("response", F.when(F.col("response").isNotNull(), F.col("id"))).alias("last")
    )
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # a row per partition
    carried = last.select("part", F.last("last", ignorenulls=True).over(earlier).alias("carried"))
    within = W.partitionBy("part").orderBy("id").rowsBetween(W.unboundedPreceding, -1)
    seen = placed.withColumn("seen", F.last("response", ignorenulls=True).over(within)).filter("type = 'revisit'")
    met = seen.join(F.broadcast(carried), "part")
    found = F.coalesce("seen", "carried")
    return met.withColumn("found", F.when(found["url"] == F.col("url"), found)).drop("seen", "carried", "response")


def _validator(name: str) -> Column:
    return F.regexp_replace(F.col("http")[name], "^W/", "")


def resolved(records: DataFrame) -> DataFrame:
    """One row per not-modified revisit: ``record_id, outcome, response_id, headers``.

    ``outcome`` is ``resolved``, ``no_response``, ``changed`` (validators differ) or
    ``no_validator``. An entity tag decides where both sides have one, else the date of
    last modification. ``headers`` are those of the response, updated by the revisit.
    """
    placed = F.col("url").isNotNull() & F.col("date").isNotNull()
    full = (F.col("type") == "response") & (F.col("status") == 200) & placed
    again = (F.col("type") == "revisit") & F.coalesce(F.col("status") == 304, F.lit(True))
    slim = records.filter(full | again).select("record_id", "type", canonical_url(F.col("url")).alias("url"), "date", "http")
    # written, as range partitions read their rows twice
    found = _latest_before(stable(slim))
    stored = F.col("found.http")
    tag, old_tag = _validator("etag"), F.regexp_replace(stored["etag"], "^W/", "")
    when, old_when = F.col("http")["last-modified"], stored["last-modified"]
    same = F.coalesce(tag == old_tag, when == old_when)
    new = F.map_filter("http", lambda k, v: ~k.isin(KEPT))
    merged = F.map_concat(F.map_filter(stored, lambda k, v: ~F.map_contains_key(new, k)), new)
    outcome = (
        F.when(F.col("found").isNull(), "no_response")
        .when(same.isNull(), "no_validator")
        .when(same, "resolved")
        .otherwise("changed")
    )
    named = found.withColumn("outcome", outcome)
    ok = F.col("outcome") == "resolved"
    return named.select(
        "record_id",
        "outcome",
        F.col("found.record_id").alias("response_id"),
        F.when(ok, merged).alias("headers"),
    )


HOT_URL = "http://hot.example/robots.txt"


def crawl(pages: DataFrame) -> DataFrame:
    """Raw records of a crawl of ``pages``, a stand-in for a crawl's files.

    Every page has a response and a revisit under another spelling, every fourth three
    versions and a revisit after them; a third of the pages also ask for one and the same
    URL. Revisits may come before any response, carry the entity tag of another version, only
    a date of last modification, or no validator.
    """
    page = F.col("page_id")
    start = F.lit(1_700_000_000)
    line = "\r\n"

    def stamp(seconds: Column) -> Column:
        return F.date_format(F.timestamp_seconds(start + seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")

    def head(kind: str, name: Column, url: Column, seconds: Column) -> list[Column]:
        return [F.lit(f"WARC/1.1{line}WARC-Type: {kind}{line}WARC-Record-ID: <urn:{kind}:"), name,
                F.lit(f">{line}WARC-Target-URI: "), url, F.lit(f"{line}WARC-Date: "), stamp(seconds), F.lit(line + line)]

    def response(name: Column, url: Column, seconds: Column, tag: Column, modified: Column, body: Column) -> Column:
        return F.concat(*head("response", name, url, seconds), F.lit(f"HTTP/1.1 200 OK{line}Content-Type: text/html{line}ETag: "), tag,
                        F.lit(f"{line}Last-Modified: "), modified, F.lit(f"{line}Server: a{line}{line}"), body)

    def revisit(name: Column, url: Column, seconds: Column, validators: Column) -> Column:
        status = f"HTTP/1.1 304 Not Modified{line}Content-Type: text/plain{line}Server: b{line}Server: c{line}"
        return F.concat(*head("revisit", name, url, seconds), F.lit(status), validators, F.lit(line))

    def tagged(tag: Column) -> Column:
        return F.concat(F.lit("ETag: W/"), tag, F.lit(line))

    def records(p: Column) -> Column:
        def tag(version: int) -> Column:
            return F.concat(F.lit('"'), p["md5"], F.lit(f'-{version}"'))

        def named(suffix: str) -> Column:
            return F.concat(page.cast("string"), F.lit(suffix))

        modified = F.concat(F.lit("day "), (page % 28).cast("string"))
        body = F.coalesce("html", F.lit(""))
        hot_tag = F.concat(F.lit('"'), F.floor(page / 120).cast("string"), F.lit('"'))
        spelling = F.concat(
            F.lit("https://www."), F.regexp_replace(F.regexp_replace("url", r"^[a-z]+://(www\.)?", ""), "#.*$", ""),
            F.when(F.contains("url", F.lit("?")), F.lit("&")).otherwise(F.lit("?")), F.lit("utm_medium=again#part"),
        )
        validators = (
            F.when(page % 7 == 0, F.lit(f'ETag: "new"{line}'))
            .when(page % 7 == 1, F.concat(F.lit("Last-Modified: "), modified, F.lit(line)))
            .when(page % 7 == 2, F.lit(""))
            .otherwise(tagged(tag(0)))
        )
        soon = page * 60 + F.when(page % 5 == 0, F.lit(-30)).otherwise(F.lit(3630))
        once_seen = [response(named("-0"), F.col("url"), page * 60, tag(0), modified, body), revisit(named("-0"), spelling, soon, validators)]
        often = [
            *[response(named(f"-{k}"), F.col("url"), page * 60 + 86_407 * k, tag(k), modified, body) for k in (1, 2)],
            revisit(named("-1"), spelling, page * 60 + 2 * 86_407 + 500, tagged(F.when(page % 8 == 0, tag(2)).otherwise(tag(1)))),
        ]
        hot = F.when(
            page % 6 == 0, response(named("-hot"), F.lit(HOT_URL), page * 60 + 7, hot_tag, F.lit("never"), F.lit("Allow: /"))
        ).otherwise(revisit(named("-hot"), F.lit(HOT_URL), page * 60 + 11, tagged(hot_tag)))
        none = F.array().cast("array<string>")
        return F.concat(
            F.array(*once_seen), F.when(page % 4 == 0, F.array(*often)).otherwise(none), F.when(page % 3 == 0, F.array(hot)).otherwise(none)
        )

    digest = F.md5(F.coalesce("html", F.lit("")).cast("binary"))
    return pages.select("page_id", "url", "html", once(digest).alias("md5")).select(
        F.explode(records(F.struct("md5"))).alias("record")
    )


def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    listed = F.transform(
        F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"])
    )
    return resolved(parsed(crawl(pages))).select(
        "record_id", "outcome", "response_id", F.array_join(listed, "\n").alias("headers")
    )


_URL_SQL = rf"""
  regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), ':(80|443)$', ''), '^www\.', '')
  || regexp_replace(regexp_replace(regexp_replace(rest, '^[^/?]*', ''),
       '([?&])(({TRACKING})=[^&]*(&|$))+', '\1', 'g'), '[?&/]+$', '')"""

OP7_SQL = rf"""
WITH c AS (SELECT page_id AS p, md5(coalesce(html, '')) AS tag, 'day ' || (page_id % 28) AS day,
                  regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM pages),
u AS (SELECT *, {_URL_SQL} AS url FROM c),
s AS (SELECT url, p * 60 + 86407 * k AS t, '<urn:response:' || p || '-' || k || '>' AS old, '"' || tag || '-' || k || '"' AS old_tag, day AS old_day
      FROM u, range(3) v(k) WHERE k = 0 OR p % 4 = 0 UNION ALL
      SELECT 'hot.example/robots.txt', p * 60 + 7, '<urn:response:' || p || '-hot>', '"' || (p // 120) || '"', 'never' FROM u WHERE p % 6 = 0),
r AS (SELECT url, p * 60 + CASE WHEN p % 5 = 0 THEN -30 ELSE 3630 END AS t, '<urn:revisit:' || p || '-0>' AS id,
             CASE p % 7 WHEN 0 THEN '"new"' WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE 'W/"' || tag || '-0"' END AS sent, CASE WHEN p % 7 = 1 THEN day END AS day FROM u UNION ALL
      SELECT url, p * 60 + 173314, '<urn:revisit:' || p || '-1>', 'W/"' || tag || CASE WHEN p % 8 = 0 THEN '-2"' ELSE '-1"' END, NULL FROM u WHERE p % 4 = 0 UNION ALL
      SELECT 'hot.example/robots.txt', p * 60 + 11, '<urn:revisit:' || p || '-hot>', 'W/"' || (p // 120) || '"', NULL FROM u WHERE p % 6 = 3),
j AS (SELECT r.id, r.sent, r.day, s.old, s.old_tag, s.old_day FROM r ASOF LEFT JOIN s ON r.url = s.url AND r.t > s.t),
o AS (SELECT *, coalesce(regexp_replace(sent, '^W/', '') = old_tag, day = old_day) AS same FROM j),
n AS (SELECT *, CASE WHEN old IS NULL THEN 'no_response' WHEN same IS NULL THEN 'no_validator' WHEN same THEN 'resolved' ELSE 'changed' END AS outcome FROM o)
SELECT id AS record_id, outcome, old AS response_id,
       CASE WHEN outcome = 'resolved' THEN 'content-type: text/html' || chr(10) || 'etag: ' || coalesce(sent, old_tag) || chr(10)
            || 'last-modified: ' || old_day || chr(10) || 'server: b, c' END AS headers
FROM n
"""
