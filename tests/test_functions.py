"""Known values of the Column functions."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from quern.functions import hashing as H, maths as M, text as X, times as D, vectors as V


@pytest.fixture(scope="module")
def one(spark):
    row = spark.range(1)

    def evaluate(c):
        return row.select(c.alias("v")).first()["v"]

    return evaluate


def vec(*values):
    return V.literal_vector(values)


def test_remove_punctuation(one):
    assert one(X.remove_punctuation(F.lit(" The Elephant's 4 cats. "))) == "the elephants 4 cats"
    assert one(X.remove_punctuation(F.lit("Hi, you!"))) == "hi you"
    assert one(X.remove_punctuation(F.lit(" No under_score!"))) == "no underscore"


def test_split_words_keeps_empty_words(one):
    assert one(X.split_words(F.lit("a  b "))) == ["a", "", "b", ""]


FOX = "A quick brown fox jumps over the lazy dog."


@pytest.mark.parametrize(
    "text, tokens",
    [
        (FOX, "a quick brown fox jumps over the lazy dog".split()),
        (" ", []),
        ("!!!!123A/456_B/789C.123A", ["123a", "456_b", "789c", "123a"]),
        ("fox fox", ["fox", "fox"]),
    ],
)
def test_simple_tokenize(one, text, tokens):
    assert one(X.simple_tokenize(F.lit(text))) == tokens


@pytest.mark.parametrize(
    "text, tokens",
    [("Why a the?", []), ("Being at the_?", ["the_"]), (FOX, "quick brown fox jumps lazy dog".split())],
)
def test_tokenize(one, text, tokens):
    assert one(X.tokenize(F.lit(text))) == tokens


def test_match_any_with_lookbehind(one):
    assert one(X.match_any(F.lit("is it's"), [r"(?<=')s", "xyz", "^is"])) == [r"(?<=')s", "^is"]


def test_remove_quotes(one):
    assert one(X.remove_quotes(F.lit('"a"b'))) == "ab"


def test_apache_time(one):
    parsed = one(D.parse_apache_time(F.lit("01/Aug/1995:00:00:01 -0400")))
    assert parsed == datetime.datetime(1995, 8, 1, 0, 0, 1)
    for bad in ("31/Feb/1995:00:00:01 -0400", "01/Xyz/1995:00:00:01 -0400", "nonsense"):
        assert one(D.parse_apache_time(F.lit(bad))) is None


def test_apache_time_ignores_the_session_zone(spark, one):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:  # 02:30 does not exist in New York on that day
        parsed = one(D.parse_apache_time(F.lit("10/Mar/2024:02:30:00 -0400")).cast("string"))
        hour = one(D.epoch_ms_hour(F.lit(1467962138212)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert parsed == "2024-03-10 02:30:00" and hour == 7


def test_sizes_and_dates(one):
    assert one(D.dash_to_zero(F.lit("-"))) == 0
    assert one(D.dash_to_zero(F.lit("1839"))) == 1839
    assert one(D.dash_to_zero(F.lit("x"))) is None
    assert one(D.yyyymmdd_to_date(F.lit(20160912))) == datetime.date(2016, 9, 12)
    assert one(D.yyyymmdd_to_date(F.lit(20161399))) is None
    assert one(D.month_floor(F.lit(datetime.date(2016, 9, 12)))) == datetime.date(2016, 9, 1)
    assert one(D.is_weekday(F.lit(datetime.date(2016, 9, 11)))) is False
    assert one(D.epoch_ms_weekday(F.lit(1467962138212))) == 5


@pytest.mark.parametrize("value, minute", [(5, "00:05"), (1230, "12:30"), (2359, "23:59"), (1275, None), (2400, None)])
def test_hhmm(one, value, minute):
    assert one(D.hhmm_to_minute(F.lit(value))) == minute


@pytest.mark.parametrize(
    "p, y, loss",
    [
        (0.5, 1, 0.69314718056),
        (0.01, 0, 0.0100503358535),
        (0.01, 1, 4.60517018599),
        (0.0, 1, 25.3284360229),
        (1.0, 1, 1.00000008275e-11),
        (1.0, 0, 25.3284360229),
    ],
)
def test_log_loss(one, p, y, loss):
    assert one(M.log_loss(F.lit(p), F.lit(y))) == pytest.approx(loss, rel=1e-8)


def test_sigmoid_is_held_within_its_bound(one):
    assert one(M.sigmoid_clipped(F.lit(0.0))) == 0.5
    assert one(M.sigmoid_clipped(F.lit(1000.0))) == one(M.sigmoid_clipped(F.lit(20.0)))
    assert one(M.sigmoid_clipped(F.lit(-1000.0))) == pytest.approx(1 / (1 + math.exp(20)))


def test_polar_coords(one):
    phi, rho = M.polar_coords(F.lit(3.0), F.lit(4.0))
    assert one(rho) == 5.0
    assert one(phi) == pytest.approx(((math.atan2(-3, -4) + math.pi / 2) % (2 * math.pi)) / (2 * math.pi))


def test_vector_products(one):
    assert one(V.vec_scale(vec(1, -2, 0), 3.0)) == [3, -6, 0]
    assert one(V.vec_mul(vec(1, 2, 3), vec(4, 5, 6))) == [4, 10, 18]
    assert one(V.vec_dot(vec(1, -3), vec(4, 5))) == -11
    assert one(V.vec_dot(vec(3, 4, 5), vec(1, 2, 3))) == 26
    half = [x / 2 for x in range(10)]
    assert one(V.vec_dot(vec(*half), vec(*[x + 5 for x in half]))) == 183.75
    assert one(V.vec_dot(vec(3, 4, 5), vec(-3, -4, 5))) == 0
    assert one(V.vec_slice(vec(1, 2, 3, 4), 3)) == [2, 3, 4]
    assert one(V.vec_concat(vec(1), vec(2, 3))) == [1, 2, 3]


def test_folds(one):
    six = vec(*range(6))
    assert one(V.fold_by_period(six, 2)) == [6, 9]
    assert one(V.fold_by_period(six, 3)) == [3, 5, 7]
    assert one(V.fold_by_block(six, 3)) == [3, 12]
    assert one(V.fold_by_block(six, 2)) == [1, 5, 9]
    tile = [[1, 0, 1, 0, 1, 0], [0, 1, 0, 1, 0, 1]]
    assert one(V.apply_matrix(six, tile)) == [6, 9]


def test_series(one):
    assert one(V.series_std(vec(1, 2, 3, 4))) == pytest.approx(math.sqrt(1.25))
    assert one(V.rescale_series(vec(1, 2, 3))) == [-0.5, 0, 0.5]


def test_interactions(one):
    assert one(V.two_way_interactions(vec(2, 3))) == [2, 3, 4, 6, 6, 9]
    assert one(V.two_way_interactions(vec(1, 2, 3))) == [1, 2, 3, 1, 2, 3, 2, 4, 6, 3, 6, 9]


def test_md5_bucket(one):
    assert [one(H.md5_bucket(F.lit(s), 100)) for s in ("bear0", "black1", "salmon2")] == [72, 14, 5]


def test_md5_bucket_equals_big_integers(spark):
    import hashlib

    words = [f"w{i}" for i in range(200)]
    rows = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r.b for r in rows.select(H.md5_bucket(F.col("w"), 2**30).alias("b")).collect()]
    assert got == [int(hashlib.md5(w.encode()).hexdigest(), 16) % 2**30 for w in words]
