"""Embedding near-duplicates: epsilon grid order join of unit vectors.

Unit vectors with a cosine of at least ``t`` are at most ``sqrt(2 - 2t)`` apart. Vectors are
projected on the leading principal dimensions, sorted by label and by the grid cells of that
width, and cut into intervals of the sequence. Pairs of intervals are refined from the whole
sequence down, sixteen parts a level, and a pair whose boxes are further apart than that
width, or whose labels do not meet, goes with all its parts; a task goes on halving the
intervals of a pair it is given. Projections never lengthen a distance, so no link is lost;
what is left is compared in double precision.

Defined results: a vector that is null, empty or zero, or that holds null or non-finite
components, and a vector without a label, links with nothing; vectors of different lengths
do not link; equal vectors of a label are joined as one, with their number; every row counts
as a vector of its own, also where ids repeat; a component has the smallest id that is not
null; a row with a null id is kept only if no row of its component has one; cosines within
1e-9 of the threshold are decided on exactly rounded sums; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from quern.llm.common import stable, with_arrow_column
from quern.llm.simhash import components, spanning_forest
from quern.operators.joins import lookup_join
from quern.operators.ordering import zip_with_index
from quern.operators.stats import cross_products

DIMENSIONS = 6  # leading principal dimensions of the grid
INTERVAL_ROWS = 4096
LEAF_ROWS = 256
FAN = 4  # bits of an interval's number that one level of the refinement resolves
RUN = 64  # partners of an interval that one copy of it serves
SLACK = 1e-9


def usable(vector: Column) -> Column:
    """Whether a vector can have a cosine: finite components only, one of them not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _scaled(x: np.ndarray) -> np.ndarray:
    """Vectors times a power of two, which rounds nothing, so that no square leaves the range of doubles."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(-1, keepdims=True))[1])


def unit(flat: np.ndarray, width: int) -> np.ndarray:
    """Rows of length 1 in double precision."""
    x = _scaled(flat.reshape(-1, width).astype(np.float64))
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _lists(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the lists of one length, and their unit vectors; one pair for each length."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    for width in np.unique(lengths):
        at = np.flatnonzero(lengths == width)
        yield at, unit(column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False), int(width))


def _numbered(labels: Column, rows: DataFrame) -> DataFrame:
    """Adds ``group``, a number that equal labels share."""
    if isinstance(rows.schema["label"].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return rows.withColumn("group", labels.cast("bigint"))
    names = stable(zip_with_index(rows.select("label").distinct(), ["label"], "group"))
    return lookup_join(rows, names, "label")


def principal(heads: DataFrame, width: int, dimensions: int) -> np.ndarray:
    """The leading principal directions of the unit vectors of that length, as columns.

    Tasks hand on one matrix of products each; ``(width + 1) ** 2`` sums reach the driver.
    """

    def with_one():
        def make(values: list) -> pa.Array:
            x = unit(np.array(values, np.float64), width) if values else np.empty((0, width))
            return pa.array(list(np.column_stack([x, np.ones(len(x))])), pa.list_(pa.float64()))

        return make

    rows = with_arrow_column(heads.filter(F.size("v") == width).select("v"), "v", "u", T.ArrayType(T.DoubleType()), with_one)
    sums = cross_products(rows, "u").toArrow()
    total = np.zeros((width + 1, width + 1))
    total[sums["i"].to_numpy(), sums["j"].to_numpy()] = sums["v"].to_numpy()
    n, mean = total[-1, -1], total[-1, :-1] / total[-1, -1]
    _, axes = np.linalg.eigh(total[:-1, :-1] / n - np.outer(mean, mean))
    return np.ascontiguousarray(axes[:, ::-1][:, :dimensions])


def _projected(heads: DataFrame, axes: np.ndarray) -> DataFrame:
    """Adds ``p``; vectors of another length than the axes have all zeros, so that no box parts them."""

    def make():
        k = axes.shape[1]

        def project(values: list) -> pa.Array:
            p = np.zeros((len(values), k))
            for at, u in _lists(pa.array(values, pa.list_(pa.float64()))):
                if u.shape[1] == len(axes):
                    p[at] = u @ axes
            return pa.array(list(p), pa.list_(pa.float64()))

        return project

    return with_arrow_column(heads, "v", "p", T.ArrayType(T.DoubleType()), make)


INTERVAL = "part int, no int, width int, groups binary, reps binary, copies binary, vectors binary, p binary"


def _intervals(rows: int, single: bool):
    """Cuts a sorted partition ``group, rep, n, v, p`` into intervals; one never mixes lengths of vectors."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no = TaskContext.get().partitionId(), 0
        held: list[pa.Table] = []

        def row(table: pa.Table) -> pa.RecordBatch:
            v = table["v"].combine_chunks()
            cells = [
                table["group"].to_numpy().astype("<i8"), table["rep"].to_numpy().astype("<i8"), table["n"].to_numpy().astype("<i8"),
                v.flatten().to_numpy(zero_copy_only=False).astype("<f4" if single else "<f8"),
                table["p"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype("<f8"),
            ]
            head = [pa.array([x], pa.int32()) for x in (part, no, len(v[0]))]
            return pa.RecordBatch.from_arrays(
                [*head, *[pa.array([c.tobytes()], pa.binary()) for c in cells]], [f.split()[0] for f in INTERVAL.split(", ")]
            )

        for batch in batches:
            lengths = batch.column("v").value_lengths().to_numpy(zero_copy_only=False)
            for piece in np.split(np.arange(len(lengths)), np.flatnonzero(np.diff(lengths)) + 1):
                at = 0
                while at < len(piece):
                    if held and len(held[0]["v"][0]) != lengths[piece[0]]:
                        yield row(pa.concat_tables(held))
                        held, no = [], no + 1
                    take = min(len(piece) - at, rows - sum(map(len, held)))
                    held.append(pa.Table.from_batches([batch.slice(int(piece[at]), take)]))
                    at += take
                    if sum(map(len, held)) == rows:
                        yield row(pa.concat_tables(held))
                        held, no = [], no + 1
        if held:
            yield row(pa.concat_tables(held))

    return cut


def _boxes(intervals: DataFrame, k: int) -> DataFrame:
    """``seq`` and the bounds of each interval, without its vectors."""
    sides = [f"{side}{i}" for side in ("low", "high") for i in range(k)]
    schema = ", ".join(["seq bigint", "width bigint", "first bigint", "last bigint", *[f"{s} double" for s in sides]])

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for seq, width, groups, p in zip(*[c.to_pylist() for c in batch.columns]):
                g, x = np.frombuffer(groups, "<i8"), np.frombuffer(p, "<f8").reshape(-1, k)
                values = [seq, width, int(g.min()), int(g.max()), *x.min(0).tolist(), *x.max(0).tolist()]
                yield pa.RecordBatch.from_pydict(dict(zip(["seq", "width", "first", "last", *sides], [[v] for v in values])))

    return intervals.select("seq", "width", "groups", "p").mapInArrow(bounds, schema)


def _candidates(boxes: DataFrame, n: int, k: int, eps: float) -> DataFrame:
    """Pairs ``a <= b`` of intervals that no box or label keeps apart, refined level by level."""
    levels = 0
    while n > 1 << FAN * levels:
        levels += 1
    pairs = boxes.sparkSession.createDataFrame([(0, 0)], "a bigint, b bigint")
    least = ["width_low", "first", *[f"low{i}" for i in range(k)]]
    most = ["width_high", "last", *[f"high{i}" for i in range(k)]]
    spans = boxes.withColumnsRenamed({"width": "width_low"}).withColumn("width_high", F.col("width_low"))
    for level in range(levels - 1, -1, -1):
        nodes = spans.groupBy(F.shiftright("seq", FAN * level).alias("seq")).agg(
            *[F.min(c).alias(c) for c in least], *[F.max(c).alias(c) for c in most]
        )

        def side(name: str) -> DataFrame:
            return nodes.select(
                F.col("seq").alias(f"{name}_seq"), F.shiftright("seq", FAN).alias(name),
                *[F.col(c).alias(f"{name}_{c}") for c in (*least, *most)],
            )

        met = pairs.join(side("a"), "a").join(side("b"), "b")
        near = [F.col("a_seq") <= F.col("b_seq")]
        for low, high in (("width_low", "width_high"), ("first", "last")):
            near += [F.col(f"a_{low}") <= F.col(f"b_{high}"), F.col(f"b_{low}") <= F.col(f"a_{high}")]
        gaps = [
            F.greatest(F.lit(0.0), F.col(f"b_low{i}") - F.col(f"a_high{i}"), F.col(f"a_low{i}") - F.col(f"b_high{i}"))
            for i in range(k)
        ]
        distance = sum((g * g for g in gaps[1:]), gaps[0] * gaps[0])
        for c in (*near, distance <= eps * eps + SLACK):
            met = met.filter(c)
        pairs = met.select(F.col("a_seq").alias("a"), F.col("b_seq").alias("b"))
    return pairs


class _Side:
    """One interval in a task."""

    def __init__(self, width: int, groups: bytes, reps: bytes, copies: bytes, vectors: bytes, p: bytes):
        self.group, self.rep, self.n = (np.frombuffer(x, "<i8") for x in (groups, reps, copies))
        flat = np.frombuffer(vectors, "<f4" if len(vectors) == 4 * width * len(self.rep) else "<f8")
        self.raw, self.u = flat.reshape(-1, width), unit(flat, width)
        self.p = np.frombuffer(p, "<f8").reshape(len(self.rep), -1)


def _exact(x: np.ndarray, y: np.ndarray) -> float:
    """Cosine on exactly rounded sums, the same in whatever order vectors meet."""
    x, y = (_scaled(v.astype(np.float64)) for v in (x, y))
    return math.fsum(x * y) / (math.sqrt(math.fsum(x * x)) * math.sqrt(math.fsum(y * y)))


def compare(a: _Side, b: _Side, same: bool, threshold: float, leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``rep, root, links`` of the vectors of two intervals that link: a spanning forest and the copies each links with."""
    limit = 2 - 2 * threshold + SLACK
    links_a, links_b = np.zeros(len(a.rep), np.int64), np.zeros(len(b.rep), np.int64)
    us, vs = [], []
    left = [(0, len(a.rep), 0, len(b.rep))]
    while left:
        i, j, k, m = left.pop()
        gap = np.maximum(0, np.maximum(b.p[k:m].min(0) - a.p[i:j].max(0), a.p[i:j].min(0) - b.p[k:m].max(0)))
        if gap @ gap > limit or a.group[i:j].min() > b.group[k:m].max() or b.group[k:m].min() > a.group[i:j].max():
            continue
        own = same and i == k
        if max(j - i, m - k) > leaf:
            h = (i + j) // 2
            if own:
                left += [(i, h, i, h), (i, h, h, j), (h, j, h, j)]
            elif j - i >= m - k:
                left += [(i, h, k, m), (h, j, k, m)]
            else:
                g = (k + m) // 2
                left += [(i, j, k, g), (i, j, g, m)]
            continue
        cosine = a.u[i:j] @ b.u[k:m].T
        hit = (cosine >= threshold + SLACK) & (a.group[i:j, None] == b.group[None, k:m])
        edge = (np.abs(cosine - threshold) < SLACK) & (a.group[i:j, None] == b.group[None, k:m])
        for x, y in zip(*np.nonzero(edge)):
            hit[x, y] = _exact(a.raw[i + x], b.raw[k + y]) >= threshold
        if own:
            hit = np.triu(hit, 1)
        x, y = np.nonzero(hit)
        if len(x):
            links_a[i:j] += hit @ b.n[k:m]
            links_b[k:m] += a.n[i:j] @ hit
            u, v = spanning_forest(a.rep[i + x], b.rep[k + y])
            us.append(u)
            vs.append(v)
    if same:
        links_a, links_b = links_a + links_b, np.zeros(0, np.int64)
    reps, links = np.concatenate([a.rep, b.rep[: len(links_b)]]), np.concatenate([links_a, links_b])
    reps, links = reps[links > 0], links[links > 0]
    roots = reps.copy()
    if us:
        nodes, root = spanning_forest(np.concatenate(us), np.concatenate(vs))
        if len(nodes):
            at = np.minimum(np.searchsorted(nodes, reps), len(nodes) - 1)
            roots = np.where(nodes[at] == reps, root[at], reps)
    return reps, roots, links


def _comparisons(threshold: float, leaf: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                seq_a, seq_b, width, *cells = (batch.column(c)[r].as_py() for c in range(batch.num_columns))
                a, b = _Side(width, *cells[:5]), _Side(width, *cells[5:])
                found = compare(a, b, seq_a == seq_b, threshold, leaf)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], ["rep", "root", "links"])

    return run


def links(
    heads: DataFrame, threshold: float, dimensions: int = DIMENSIONS, interval_rows: int = INTERVAL_ROWS, leaf_rows: int = LEAF_ROWS
) -> DataFrame:
    """``rep, root, links`` of distinct vectors ``label, v, n, rep``: a row for each pair of intervals that links a vector.

    Edges from ``rep`` to ``root`` connect vectors as all links do, without listing those;
    ``links`` adds up to the number of rows that a vector's links lead to.
    """
    common = heads.groupBy(F.size("v").alias("w")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").first()
    if common is None:
        return heads.sparkSession.createDataFrame([], "rep bigint, root bigint, links bigint")
    axes = principal(heads, common.w, dimensions)
    k, eps = axes.shape[1], math.sqrt(max(0.0, 2 - 2 * threshold))
    placed = _projected(_numbered(F.col("label"), heads).select("group", "rep", "n", "v"), axes)
    cells = F.transform("p", lambda x: F.floor(x / F.lit(eps or 1.0)))
    order = ["group", F.size("v"), cells, "p", "rep"]
    single = isinstance(heads.schema["v"].dataType.elementType, T.FloatType)
    cut = stable(
        placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_intervals(interval_rows, single), INTERVAL)
    )
    counts = cut.groupBy("part").agg(F.count("*").alias("n"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # a row per partition
    offsets = stable(counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    intervals = cut.join(F.broadcast(offsets), "part").withColumn("seq", F.col("offset") + F.col("no")).drop("part", "no", "offset")
    units = stable(_candidates(stable(_boxes(intervals, k)), cut.count(), k, eps))
    # an interval with many partners travels in as many copies as serve RUN of them each
    copies = stable(units.groupBy("a").agg(F.ceil(F.count("*") / RUN).cast("int").alias("copies")))
    dealt = units.join(copies, "a").withColumn("copy", F.pmod(F.xxhash64("b"), F.col("copies")).cast("int")).drop("copies")
    each = F.explode(F.sequence(F.lit(0), F.col("copies") - 1))
    names = ["groups", "reps", "copies", "vectors", "p"]

    def payload(side: str) -> DataFrame:
        return intervals.select(F.col("seq").alias(side), "width", *[F.col(c).alias(f"{side}_{c}") for c in names])

    first = payload("a").join(copies, "a").withColumn("copy", each).drop("copies")
    pairs = dealt.join(first, ["a", "copy"]).join(payload("b"), ["b", "width"])
    rows = pairs.select("a", "b", "width", *[f"{side}_{c}" for side in "ab" for c in names])
    return rows.mapInArrow(_comparisons(threshold, leaf_rows), "rep bigint, root bigint, links bigint")


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.93, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    **sizes: int,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row; vectors link only within their label."""
    v = F.col(f"`{vector}`")
    kind = vectors.schema[vector].dataType.elementType
    v = v if isinstance(kind, (T.FloatType, T.DoubleType)) else v.cast("array<double>")
    slim = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{label}`").alias("label"), v.alias("v"))
    rows = stable(slim.withColumn("takes_part", usable(F.col("v")) & F.col("label").isNotNull()))
    part = rows.filter("takes_part").drop("takes_part")
    heads = stable(
        part.groupBy("label", "v")
        .agg(F.count("*").alias("n"), F.min("vec_id").alias("low"))
        .withColumn("rep", F.monotonically_increasing_id())
    )
    found = stable(links(heads, threshold, **sizes))
    counted = found.groupBy("rep").agg(F.sum("links").alias("links"))
    edges = found.filter("rep <> root").select(F.col("rep").alias("u"), F.col("root").alias("v"))
    roots = components(edges).select(F.col("node").alias("rep"), "root")
    slim_heads = heads.select("rep", "low", "n")
    named = slim_heads.join(counted, "rep", "left").join(roots, "rep", "left")
    named = stable(named.withColumn("root", F.coalesce("root", "rep")).withColumn("links", F.coalesce("links", F.lit(0)) + F.col("n") - 1))
    lowest = stable(named.groupBy("root").agg(F.min("low").alias("component_id")))
    by_rep = stable(named.select("rep", "links", "root").join(lowest, "root").select("rep", "links", "component_id"))
    # both sides are written, so that Spark can split the rows of a frequent vector
    info = stable(heads.select("label", "v", "rep").join(by_rep, "rep").select("label", "v", "links", "component_id"))
    linked = part.join(info, ["label", "v"]).select("vec_id", F.col("links").alias("n_links"), "component_id")
    alone = rows.filter("not takes_part").select("vec_id", F.lit(0).cast("bigint"), "vec_id")
    return linked.unionAll(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


#: All pairs of a label, and what they reach.
OP13_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS i, b.vec_id AS j FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT vec_id AS i, vec_id AS c FROM embeddings UNION SELECT l.j, r.c FROM r JOIN l ON r.i = l.i)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.i = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM (SELECT i AS vec_id, min(c) AS component_id FROM r GROUP BY i)
"""
