"""Line parsers and readers on literal input."""

import datetime

import pytest
from pyspark.sql import functions as F

from quern.session import scratch_path
from quern.sources import parsers as P, readers as R

GOOD = '127.0.0.1 - - [01/Aug/1995:00:00:01 -0400] "GET /images/launch-logo.gif HTTP/1.0" 200 1839'


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_access_log_line(spark):
    row = P.parse_clf(lines(spark, GOOD)).first()
    assert row.status == 1 and row.raw == GOOD
    assert (row.host, row.client_identd, row.user_id) == ("127.0.0.1", "-", "-")
    assert row.date_time == datetime.datetime(1995, 8, 1, 0, 0, 1)
    assert (row.method, row.endpoint, row.protocol) == ("GET", "/images/launch-logo.gif", "HTTP/1.0")
    assert (row.response_code, row.content_size) == (200, 1839)


def test_access_log_variants(spark):
    dash = GOOD.replace("1839", "-")
    short = GOOD.replace(" HTTP/1.0", "")
    spaced = GOOD.replace("launch-logo", "launch logo")
    bad_day = GOOD.replace("01/Aug", "45/Aug")
    parsed = P.parse_clf(lines(spark, dash, short, spaced, bad_day, "junk", None)).collect()
    assert [r.status for r in parsed] == [1, 1, 0, 0, 0, 0]
    assert parsed[0].content_size == 0 and parsed[1].protocol == ""
    assert P.parse_clf(lines(spark, spaced), spaced_endpoints=True).first().endpoint == "/images/launch logo.gif"


def test_good_and_bad_lines_are_counted(spark):
    valid, invalid, counts = P.split_valid_invalid(P.parse_clf(lines(spark, GOOD, "junk", GOOD)))
    assert valid.count() == 2 and [r.raw for r in invalid.collect()] == ["junk"]
    assert tuple(counts.first()) == (3, 2, 1)


def test_user_agent(spark):
    agent = (
        "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_11_5) AppleWebKit/537.36 (KHTML, like Gecko) "
        "Chrome/51.0.2704.103 Safari/537.36"
    )
    first, second = P.parse_user_agent(lines(spark, agent, "curl/8"), "value").collect()
    assert first.parse_ok and first.os_ver == "Macintosh; Intel Mac OS X 10_11_5"
    assert (first.browser_compatibility, first.platform) == ("Mozilla/5.0", "AppleWebKit/537.36")
    assert (first.enhancement_1, first.enhancement_2) == ("Chrome/51.0.2704.103", "Safari/537.36")
    assert not second.parse_ok and second.os_ver is None


def test_product_lines(spark):
    parsed = P.parse_quoted_product(
        lines(spark, '"id","title","description","manufacturer","price"', '"b1","a title","a, b","acme","1"', "junk")
    )
    rows = parsed.collect()
    assert [r.status for r in rows] == [0, 1, -1]
    assert (rows[1].id, rows[1].product) == ("b1", 'a title "a, b" "acme"')
    assert tuple(P.split_valid_invalid(parsed)[2].first()) == (3, 1, 1)


def test_gold_mapping_lines(spark):
    rows = P.parse_gold_mapping(lines(spark, '"left","right"', '"b1","http://x/1"', "junk"), header_key='"left"').collect()
    assert [r.status for r in rows] == [0, 1, -1]
    assert rows[1].pair == "b1 http://x/1"


def test_ratings_and_movies(spark):
    good = "3000000000::1193::5::978300760"
    assert tuple(P.parse_ratings(lines(spark, good)).first()) == (good, 1, 3_000_000_000, 1193, 5.0)
    assert tuple(P.parse_movies(lines(spark, "1::Toy Story (1995)::Animation|Comedy")).first())[1:] == (1, 1, "Toy Story (1995)")
    for bad in ("x", "", "1::2::good::3", "1::2"):
        assert tuple(P.parse_ratings(lines(spark, bad)).first()) == (bad, -1, None, None, None)
    assert [r.status for r in P.parse_movies(lines(spark, "x::a::b", "7")).collect()] == [-1, -1]


def test_labelled_rows(spark):
    row = P.parse_labeled_csv(lines(spark, "2001.0,0.88,0.61")).first()
    assert row.status == 1 and row.label == 2001.0 and row.features == [0.88, 0.61]
    assert tuple(P.parse_labeled_csv(lines(spark, "2001,?")).first()) == ("2001,?", -1, None, None)


@pytest.mark.parametrize("separator", [",", "\t"])
def test_clicks(spark, separator):
    row = P.parse_ctr(lines(spark, separator.join(["0", "1", "", "68fd1e64"]))).first()
    assert row.status == 1 and row.label == 0.0
    assert tuple(P.parse_ctr(lines(spark, separator.join(["a", "1"]))).first())[1:] == (-1, None, None)
    assert [(f.feature, f.value) for f in row.features] == [(0, "1"), (1, ""), (2, "68fd1e64")]


def test_series(spark):
    row = P.parse_series(lines(spark, "3 4 103.0 107.5 99")).first()
    assert (row.status, row.x, row.y, row.ts) == (1, 3, 4, [103.0, 107.5, 99.0])
    assert [r.status for r in P.parse_series(lines(spark, "3 4 a", "3", "")).collect()] == [-1, -1, -1]


def test_json_lines(spark):
    rows = R.parse_json_lines(lines(spark, '{"action":"hover","obj_id":"a","extra":1}', "junk"), "action string, obj_id string")
    assert [tuple(r) for r in rows.collect()] == [("hover", "a"), (None, None)]


def test_compressed_lines_are_spread(spark):
    path = scratch_path(spark, "gz")
    spark.range(1000).select(F.col("id").cast("string")).coalesce(1).write.option("compression", "gzip").text(path)
    read = R.read_lines(spark, path, min_partitions=5)
    assert read.rdd.getNumPartitions() == 5 and read.count() == 1000


def test_stop_words_are_distinct(spark):
    path = scratch_path(spark, "stop")
    lines(spark, "a", "the", "a").write.text(path)
    assert sorted(r.token for r in R.read_stopwords(spark, path).collect()) == ["a", "the"]


def test_private_characters_stay_in_fields(spark):
    mark = "\ue000"
    name = f'"a{mark}b","some {mark}{mark} name","d{mark}","m",1'
    plain = '"ab","some  name","d","m",1'
    with_mark, without = (P.parse_quoted_product(lines(spark, x)).first() for x in (name, plain))
    assert without.status == with_mark.status == 1
    assert with_mark.id == f"a{mark}b" and with_mark.product.replace(mark, "") == without.product and with_mark.product.count(mark) == 3
    assert P.parse_quoted_product(lines(spark, f"junk {mark}")).first().status == -1


JSON_LINES = [
    '{"b":"x","a":1,"c":1.25,"d":[1,2],"e":{"k":null}}', '{"a":3000000000,"c":2,"b":null,"e":{"k":"v"}}', "",
    '{"z":true,"c":1e300,"OBJECT":1,"with space":"VOID","m":1}', '{"m":"text","d":[]}',
]


@pytest.mark.parametrize("bad", [[], ["junk", "[1, 2]", "17"]])
def test_json_schema_in_one_read(spark, bad):
    path = scratch_path(spark, "json")
    lines(spark, *JSON_LINES, *bad).repartition(3).write.text(path)
    ours, theirs = R.read_json_inferred(spark, path), spark.read.json(path)
    assert sorted(ours.dtypes) == sorted(theirs.dtypes)
    columns = [f"`{c}`" for c in theirs.columns]
    assert sorted(map(str, ours.select(*columns).collect())) == sorted(map(str, theirs.select(*columns).collect()))
    assert "FileScan text" not in ours._jdf.queryExecution().executedPlan().toString()


def test_json_without_fields(spark):
    path = scratch_path(spark, "json")
    lines(spark, "junk", "").write.text(path)
    assert [r._corrupt_record for r in R.read_json_inferred(spark, path).collect()] == ["junk"]


def test_declared_schemas(spark):
    path = scratch_path(spark, "declared")
    lines(spark, '{"a":1,"b":"x"}').write.text(path)
    assert R.read_json_inferred(spark, path, "a int").collect() == [(1,)]
    spark.createDataFrame([(1, "2024-01-02")], "a int, d string").write.csv(path + "-csv", header=True)
    assert R.read_csv_union(spark, path + "-csv", "a bigint, d date").dtypes == [("a", "bigint"), ("d", "date")]
