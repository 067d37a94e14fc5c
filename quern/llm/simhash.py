"""SimHash near-duplicates: fingerprints within a few bits, found by exact tiled comparison.

Fingerprints are cut into tiles by the population counts of their four quarters. Two
fingerprints within ``radius`` bits differ by at most ``radius`` in the sum of the absolute
differences of those counts, so tile pairs beyond that are never formed; the others are
compared whole with exclusive-or and bit counts in numpy. No link is lost.

Defined results: a null text is an empty one and has fingerprint zero; equal texts share a
fingerprint and are compared once; rows with a null id take part in linking, and a component
has the smallest id that is not null (null if it has none); an empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quern.llm.common import documents, fresh, stable, with_arrow_column

TILE_ROWS = 1024
_SHINGLES = 1 << 15
_BASE = 32  # of a tile's key: quarter counts are digits 0..16, so a step of 3 never meets another valid key


def fingerprint(text: str | None, words: int = 3) -> int:
    """Signed 64-bit SimHash of the shingles of a text; repeats count each time."""
    tokens = (text or "").encode().lower().split()  # bytes: only A-Z are lowered, only ASCII blanks split
    if not tokens:
        return 0
    count = max(1, len(tokens) - words + 1)
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for begin in range(0, count, _SHINGLES):  # bits take 64 bytes a shingle: a slice at a time
        part = tokens[begin : begin + _SHINGLES + words - 1]
        shingles = map(b" ".join, zip(*[part[i:] for i in range(words)])) if len(tokens) >= words else [b" ".join(tokens)]
        h = np.array([digest(s, 42) for s in shingles], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits((2 * ones > count).astype(np.uint8), bitorder="little")
    return int(bits.view("<i8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fingerprint", words: int = 3) -> DataFrame:
    """Adds the fingerprint as a bigint; a column of that name is replaced."""

    def make():
        return lambda texts: pa.array([fingerprint(t, words) for t in texts], pa.int64())

    return with_arrow_column(docs, text, out, T.LongType(), make)


def _tile(fp: Column) -> Column:
    quarter = [F.bit_count(F.shiftrightunsigned(fp, 16 * i).bitwiseAND(0xFFFF)) for i in range(4)]
    return sum((q * _BASE**i for i, q in enumerate(quarter[1:], 1)), quarter[0]).cast("int")


def _steps(radius: int) -> list[int]:
    """Differences of tile keys within the radius, one of each pair of opposites, and zero."""
    steps = [
        sum(d * _BASE**i for i, d in enumerate(ds))
        for ds in itertools.product(range(-radius, radius + 1), repeat=4)
        if sum(map(abs, ds)) <= radius
    ]
    return sorted(s for s in steps if s >= 0)


def spanning_forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (node, smallest node reachable) of a graph, without the roots themselves."""
    nodes, index = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = index[: len(u)], index[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    inner = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[inner], nodes[label[inner]]


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(0), batch.column(1)
            same = batch.column(2).to_pylist()
            a_all, a_at = left.values.to_numpy(), left.offsets.to_numpy()
            b_all, b_at = right.values.to_numpy(), right.offsets.to_numpy()
            us, vs = [], []
            for i in range(len(batch)):
                a, b = a_all[a_at[i] : a_at[i + 1]], b_all[b_at[i] : b_at[i + 1]]
                near = np.bitwise_count((a[:, None] ^ b[None, :]).view(np.uint64)) <= radius
                if same[i]:
                    near = np.triu(near, 1)
                x, y = np.nonzero(near)
                if len(x):
                    u, v = spanning_forest(a[x], b[y])
                    us.append(u)
                    vs.append(v)
            none = [np.empty(0, np.int64)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(us or none)), pa.array(np.concatenate(vs or none))], ["u", "v"]
            )

    return run


def links(fps: DataFrame, fp: str, radius: int = 3, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Edges ``u, v`` that connect distinct fingerprints as all pairs within ``radius`` bits do.

    Each pair of tiles yields a spanning forest of its links, at most as many edges as it
    has fingerprints: a group of near copies never spreads into all its pairs. There are at
    most 17**4 tile keys, whatever the input; a key with many rows is cut into tiles of
    about ``tile_rows``, and each pair of tiles is a row that any task may take.
    """
    keyed = fps.select(F.col(fp).alias("fp"), _tile(F.col(fp)).alias("key"))
    counts = stable(
        keyed.groupBy("key").agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("parts"))
    )
    placed = keyed.join(F.broadcast(counts), "key")  # at most 83,521 rows of two integers
    tiles = placed.groupBy(
        "key", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int").alias("part")
    ).agg(F.collect_list("fp").alias("fps"))
    steps = F.explode(F.array(*[F.lit(s) for s in _steps(radius)]))
    near = counts.select(F.col("key").alias("key1"), F.col("parts").alias("parts1"), steps.alias("step"))
    near = near.withColumn("key2", F.col("key1") + F.col("step"))
    other = counts.select(F.col("key").alias("key2"), F.col("parts").alias("parts2"))

    def numbers(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    units = (
        near.join(other, "key2")
        .withColumn("part1", numbers("parts1"))
        .withColumn("part2", numbers("parts2"))
        .filter("key1 < key2 or part1 <= part2")
        .select("key1", "part1", "key2", "part2")
    )
    tiles = stable(tiles)
    first = tiles.select(F.col("key").alias("key1"), F.col("part").alias("part1"), F.col("fps").alias("a"))
    second = tiles.select(F.col("key").alias("key2"), F.col("part").alias("part2"), F.col("fps").alias("b"))
    pairs = units.join(first, ["key1", "part1"]).join(second, ["key2", "part2"])
    same = (F.col("key1") == F.col("key2")) & (F.col("part1") == F.col("part2"))
    return pairs.select("a", "b", same.alias("same")).mapInArrow(_compare(radius), "u bigint, v bigint")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of the edges ``u, v``: alternating large and small stars.

    Every round replaces edges by edges to the smallest neighbour, first of the larger and
    then of the smaller neighbours of a node, until nothing changes. Smallest neighbours are
    aggregated, never listed, so a hub is only many rows of a join that Spark may split.
    """

    def table(df: DataFrame) -> DataFrame:
        return stable(df.distinct())

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    e = table(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v"))
    seen = state(e)
    while True:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stable(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = table(both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = stable(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
        e = table(small.unionAll(least.select("u", F.col("m").alias("v"))))
        now = state(e)
        if now == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now


def groups(fps: DataFrame, fp: str, radius: int = 3) -> DataFrame:
    """``fp, root`` of every distinct fingerprint; those without a link are their own root."""
    heads = stable(fps.select(F.col(fp).alias("fp")).distinct())
    roots = components(links(heads, "fp", radius)).withColumnRenamed("node", "fp")
    joined = heads.join(roots, "fp", "left")
    return stable(joined.select("fp", F.coalesce("root", "fp").alias("root")))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, radius: int = 3
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row: the smallest id reachable over links."""
    slim = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = stable(with_fingerprint(slim, "text", "fingerprint", words).drop("text"))
    root = groups(rows, "fingerprint", radius)
    smallest = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("low"))
    by_fp = stable(smallest.join(root.withColumnRenamed("fp", "fingerprint"), "fingerprint"))
    by_root = stable(by_fp.groupBy("root").agg(F.min("low").alias("component_id")))
    # a giant component or a frequent fingerprint: both sides are scans, so that Spark can split the skewed one
    named = stable(by_fp.select("fingerprint", "root").join(by_root, "root").select("fingerprint", "component_id"))
    return rows.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def deduplicated(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, radius: int = 3
) -> DataFrame:
    """One row of each group stays, that with the smallest id (null last), with its columns.

    The table is written once with its fingerprints and a row number; the number, not the
    id, names the row that stays, so repeated and null ids are safe.
    """
    fp, row = fresh(docs, "_fp"), fresh(docs, "_row")
    rows = stable(with_fingerprint(docs, text, fp, words).withColumn(row, F.monotonically_increasing_id()))
    root = groups(rows, fp, radius)
    first = F.struct(F.col(f"`{doc_id}`").isNull().alias("none"), F.col(f"`{doc_id}`").alias("id"), F.col(row).alias("row"))
    heads = rows.groupBy(F.col(fp).alias("fp")).agg(F.min(first).alias("first"))
    stay = heads.join(root, "fp").groupBy("root").agg(F.min("first").alias("first"))
    return rows.join(stay.select(F.col("first.row").alias(row)), row, "left_semi").select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir))
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))
