"""SimHash groups, top-k search and revisit resolution against brute force, and odd inputs."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quern.llm import simhash, topk, warc
from quern.llm.queries import ORACLES, QUERIES
from quern.plans.check import differences, duck


def slow_fingerprint(text):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        t = t.replace(c, " ")
    words = [w for w in t.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if len(words) >= 3 else [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(fps, radius=3):
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(ids)):
        for b in range(a):
            if (fps[ids[a]] ^ fps[ids[b]]).bit_count() <= radius:
                x, y = find(ids[a]), find(ids[b])
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_simhash_query(spark, data):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op3_simhash"](spark, data).collect()}
    fps = {i: slow_fingerprint(t) for i, t in texts.items()}
    assert {i: int(r.fingerprint, 16) for i, r in got.items()} == fps
    assert {i: r.component_id for i, r in got.items()} == slow_components(fps)


@pytest.mark.parametrize("tile_rows", [3, 1024])
def test_links_of_near_fingerprints(spark, tile_rows):
    rng = random.Random(5)
    values = []
    for _ in range(12):
        v = rng.getrandbits(64)
        for _ in range(12):  # a chain, and a cloud around its start
            values.append(v)
            for _ in range(rng.choice((1, 2, 3, 4))):
                v ^= 1 << rng.randrange(64)
    values += [0, 2**64 - 1, 1 << 63, 7 << 61]
    fps = dict(enumerate(sorted(set(values))))
    signed = np.array(list(fps.values()), np.uint64).astype(np.int64).tolist()
    df = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    edges = simhash.links(df, "fp", 3, tile_rows)
    assert all((u ^ v) & (2**64 - 1) for u, v in edges.collect())
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    groups = {}
    for i, s in enumerate(signed):
        groups.setdefault(roots.get(s, s), set()).add(i)
    expected = {}
    for i, c in slow_components(fps).items():
        expected.setdefault(c, set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


@pytest.mark.parametrize("words", [1, 3])
def test_fingerprints_by_slices(words, monkeypatch):
    rng = random.Random(6)
    texts = ["", "a", "a b", *(" ".join(rng.choice("abcdefgh") for _ in range(n)) for n in (3, 4, 5, 9, 10, 11, 50))]
    whole = [simhash.fingerprint(t, words) for t in texts]
    monkeypatch.setattr(simhash, "_SHINGLES", 3)
    assert [simhash.fingerprint(t, words) for t in texts] == whole


def test_fingerprint_of_a_very_long_text(spark):
    text = " ".join(f"word{i % 9973}" for i in range(400_000))
    got = simhash.with_fingerprint(spark.createDataFrame([(text, 1)], "text string, fp int")).first()
    assert got.fingerprint & (2**64 - 1) == slow_fingerprint(text)


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(300)] + [(1001, 1000)], "u bigint, v bigint")
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    assert roots == {**{i: 0 for i in range(1, 301)}, 1001: 1000}


def test_one_of_each_group_stays(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(None, text, 1), (7, text, 2), (5, text.upper(), 3), (5, text.upper(), 4), (9, None, 5), (None, "", 6), (8, "other words here", 7), (None, "lone text of a null id", 8)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, _fp int")
    left = sorted(simhash.deduplicated(df).collect(), key=lambda r: r._fp)
    assert [r.doc_id for r in left] == [5, 9, 8, None] and left[0].text == text.upper()
    assert simhash.deduplicated(df).columns == df.columns
    named = {r.doc_id: r.component_id for r in simhash.near_duplicates(df).collect() if r.doc_id}
    assert named == {7: 5, 5: 5, 9: 9, 8: 8}
    assert simhash.deduplicated(df.limit(0)).count() == simhash.near_duplicates(df.limit(0)).count() == 0


def slow_top(rows, queries, k):
    out = []
    for q, qv in rows:
        if q in queries:
            scores = sorted(((-sum(a * b for a, b in zip(qv, v)), i) for i, v in rows if i != q))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("shard_rows, k", [(7, 5), (1000, 20)])
def test_top_k(spark, shard_rows, k):
    rng = random.Random(1)
    rows = [(i, [rng.randint(-9, 9) * (rng.random() < 0.6) for _ in range(20)]) for i in range(90)]
    rows += [(200 + i, rows[3][1]) for i in range(30)]  # ties
    df = spark.createDataFrame(rows, "vec_id bigint, vector array<bigint>")
    got = topk.top_k(df, F.col("vec_id") % 10 == 0, k, shard_rows=shard_rows, query_rows=4)
    assert sorted(map(tuple, got.collect())) == slow_top(rows, {i for i, _ in rows if i % 10 == 0}, k)


@pytest.mark.parametrize("pilot", [1, 8, 4096])
def test_pilot_and_bounds_lose_nothing(spark, pilot):
    rng = random.Random(pilot)
    rows = [(i, [rng.randint(-3, 3) + (9 if i % 6 == 0 else -9 if i % 6 == 1 else 0)] * 3 + [rng.randint(-9, 9) for _ in range(rng.choice((4, 9)))]) for i in range(240)]
    padded = [(i, v + [0] * (12 - len(v))) for i, v in rows]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id bigint, vector array<bigint>, known string, shard int")
    got = topk.top_k(df, F.col("vec_id") % 7 == 0, 6, shard_rows=11, query_rows=5, pilot_rows=pilot)
    assert sorted(map(tuple, got.collect())) == slow_top(padded, {i for i, _ in rows if i % 7 == 0}, 6)
    few = topk.top_k(df.filter("vec_id < 9"), F.col("vec_id") == 7, 20)
    assert sorted(map(tuple, few.collect())) == slow_top(padded[:9], {7}, 20)


def test_top_k_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (1, [nan, 1.0]), (2, None), (3, [inf, 0.0]), (4, [None, 1.0]), (5, [0.25]), (6, []), (None, [1.0, 1.0]), (7, [-1.0, 2.0]), (0, [1.0, 0.5])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    vectors = df.withColumn("vector", topk.scaled(F.col("embedding"), 4))
    got = topk.top_k(vectors, F.col("vec_id") == 0).collect()
    assert sorted({(r.vec_id, r.score) for r in got}) == [(5, 4), (6, 0), (7, 0)]
    assert topk.top_k(vectors.limit(0), F.lit(True)).count() == 0


RECORDS = [
    ("response", "r1", "http://Example.com/a/?utm_source=x", 10, 'HTTP/1.1 200 OK\nETag: "1"\nContent-Type: t\nX: old'),
    ("response", "r2", "https://www.example.com:443/a#f", 20, 'HTTP/1.1 200 OK\nETag: "2"\nLast-Modified: d'),
    ("response", "r3", "http://example.com/a", 25, "HTTP/1.1 404 Not Found"),
    ("revisit", "v0", "http://example.com/a", 10, 'HTTP/1.1 304 Not Modified\nETag: "1"'),
    ("revisit", "v1", "http://example.com/a", 15, 'HTTP/1.1 304 Not Modified\nETag: W/"1"\nX: new\nContent-Type: u\nV: a\nV: b'),
    ("revisit", "v2", "http://example.com/a", 30, 'HTTP/1.1 304 Not Modified\nETag: "1"'),
    ("revisit", "v3", "http://example.com/a", 30, "HTTP/1.1 304 Not Modified\nLast-Modified: d"),
    ("revisit", "v4", "http://example.com/a", 30, "HTTP/1.1 304 Not Modified"),
    ("revisit", "v5", "http://example.com/b", 30, "HTTP/1.1 304 Not Modified"),
]


def raw(kind, name, url, day, answer):
    date = f"2024-01-{day}T00:00:00Z"
    return f"WARC/1.1\nWARC-Type: {kind}\nWARC-Record-ID: {name}\nWARC-Target-URI: {url}\nWARC-Date: {date}\n\n{answer}\n\nbody\n\nmore"


def test_revisits_by_hand(spark):
    records = [raw(*r).replace("\n", e) for r, e in zip(RECORDS, ["\r\n", "\n"] * 9)] + [None, "", "junk"]
    df = spark.createDataFrame([(r, 1) for r in records], "record string, url int")
    got = {r.record_id: r for r in warc.resolved(warc.parsed(df)).collect()}
    assert {k: (r.outcome, r.response_id) for k, r in got.items()} == {
        "v0": ("no_response", None), "v1": ("resolved", "r1"), "v2": ("changed", "r2"), "v3": ("resolved", "r2"),
        "v4": ("no_validator", "r2"), "v5": ("no_response", None),
    }
    assert got["v1"].headers == {"etag": 'W/"1"', "content-type": "t", "x": "new", "v": "a, b"}
    assert warc.resolved(warc.parsed(df.limit(0))).count() == 0


def test_undated_responses_are_never_found(spark):
    rows = [("response", "r0", "http://u/", None), ("revisit", "v0", "http://u/", 5), ("response", "r1", "http://u/", 7), ("revisit", "v1", "http://u/", 9)]
    df = spark.createDataFrame(rows, "type string, record_id string, url string, t int").select(
        "type", "record_id", "url", F.timestamp_seconds("t").alias("date"),
        F.when(F.col("type") == "response", 200).otherwise(304).alias("status"),
        F.create_map(F.lit("etag"), F.lit("1")).alias("http"),
    )
    got = {r.record_id: (r.outcome, r.response_id) for r in warc.resolved(df).collect()}
    assert got == {"v0": ("no_response", None), "v1": ("resolved", "r1")}


def test_one_hot_url_over_many_partitions(spark):
    rows = [("response" if i % 10 == 0 else "revisit", f"{i:05d}", "http://h/", i) for i in range(5, 3000)]
    df = spark.createDataFrame(rows, "type string, record_id string, url string, t int").select(
        "type", "record_id", "url", F.timestamp_seconds("t").alias("date"),
        F.when(F.col("type") == "response", 200).otherwise(304).alias("status"),
        F.create_map(F.lit("etag"), F.lit("1")).alias("http"),
    )
    got = {r.record_id: r.response_id for r in warc.resolved(df).collect()}
    assert got == {f"{i:05d}": f"{i // 10 * 10:05d}" if i >= 10 else None for i in range(5, 3000) if i % 10}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, data, name):
    assert differences(QUERIES[name](spark, data), duck(data), ORACLES[name]) is None
