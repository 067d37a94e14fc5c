"""Periodic runs against a search of every period, and odd texts."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import periods
from quern.llm.queries import QUERIES


def slow_runs(words, least=6, times=4):
    """``start, length, period`` by trying every period; a stretch counts with its smallest one."""
    found, seen = [], set()
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, times * q) and (i, j) not in seen:
                if not any(s <= i and i + (j - i + q) <= s + n and q % p == 0 for s, n, p in found):
                    found.append((i, j - i + q, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def split(text):
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def slow_row(doc_id, text):
    words = split(text or "")
    n = len(words)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = slow_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = None
    for s, n, q in runs:
        if best is None or n * best[2] > best[1] * q:
            best = (s, n, q)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id, len(runs), *(best or (None,) * 3), None if best is None else 1000 * best[1] // best[2],
        sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def keys(texts):
    width = max([x for t in texts for x in t], default=0) + 2
    return np.array([k * width + x for k, t in enumerate(texts) for x in (*t, width - 1)], np.int64)


@pytest.mark.parametrize("least, times", [(6, 4), (2, 2), (5, 3)])
def test_runs_of_random_words(least, times):
    rng = random.Random(times)
    for trial in range(250):
        texts = [[rng.randrange(rng.choice((1, 2, 3))) for _ in range(rng.randrange(60))] for _ in range(rng.randrange(1, 5))]
        if trial % 3 == 0:
            word = [rng.randrange(3) for _ in range(rng.randrange(1, 12))]
            texts[0] = texts[0] + word * rng.randrange(2, 9) + texts[0][:7]
        got = periods.runs(keys(texts), max(map(len, texts)), least, times).tolist()
        expected, begin = [], 0
        for t in texts:
            expected += [[begin + s, n, q] for s, n, q in slow_runs(t, least, times)]
            begin += len(t) + 1
        assert got == expected


@pytest.mark.parametrize("chunk", [7, 1 << 20])
def test_runs_do_not_depend_on_chunks(chunk, monkeypatch):
    monkeypatch.setattr(periods, "_CHUNK", chunk)
    text = [0, 1] * 40 + [2] * 30 + [0, 1, 1] * 20
    assert periods.runs(keys([text]), len(text)).tolist() == [list(r) for r in slow_runs(text)]


def test_query(spark, data):
    rows = spark.read.parquet(f"{data}/documents.parquet").collect()
    got = QUERIES["op12_periodic_runs"](spark, data)
    assert got.columns == "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    assert sorted(map(tuple, got.collect())) == sorted(slow_row(r.doc_id, r.text) for r in rows)
    assert got.filter("n_runs > 0").count() > 10


def test_odd_texts(spark):
    texts = [None, "", " \t\x0b ", "a", "a a a a a", "a a a a a a", "x\x0by\x0cx\ry x\ny x y", "é é  é é é é é", "b c " * 30 + "d " * 7]
    rows = [(i, t) for i, t in enumerate([*texts, "u v w " * 9])] + [(None, "p q " * 5), (4, texts[4]), (3, " ".join("ab" * 3000))]
    df = spark.createDataFrame([(*r, "e", 1) for r in rows], "doc_id bigint, text string, n_runs string, found int")
    got = periods.digest(periods.damaged(df)).collect()
    assert sorted(map(tuple, got), key=str) == sorted((slow_row(*r) for r in rows), key=str)
    assert periods.digest(periods.damaged(df.limit(0))).count() == 0


def test_long_texts(spark):
    rng = random.Random(2)
    a = "w " * 200_000  # one word
    b = " ".join(str(rng.randrange(50_000)) for _ in range(100_000)) + " z y" * 20_000
    df = spark.createDataFrame([(1, a), (2, b), (3, f"{b} {b}")], "id int, text string")
    found = {r.id: r for r in periods.with_runs(df, out="r").select("id", F.col("r.runs").alias("runs"), F.length("r.collapsed").alias("n")).collect()}
    assert [tuple(r) for r in found[1].runs] == [(0, 200_000, 1)] and found[1].n == 1
    assert [tuple(r) for r in found[2].runs] == [(100_000, 40_000, 2)]
    assert [r.start for r in found[3].runs] == [100_000, 240_000]
