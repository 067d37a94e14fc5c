"""Byte-level BPE encoding and decoding of whole texts.

A text longer than one chunk is cut into overlapping chunks that are pre-tokenised in
parallel. Inside each overlap the two neighbours are stitched at the first pre-token
boundary that both have; the pieces between such boundaries are encoded in parallel. Where
an overlap has no common boundary its chunks become one piece. Decoding joins raw bytes.

A pre-token depends only on the text from its start to two characters beyond it, so two
chains of pre-tokens that share a boundary agree from there on. Pieces end after a
character that is not blank, because only blanks look ahead for what follows them.

Defined results: a null or empty text has no ids; repeated rows and rows with a null id are
encoded each on their own; an empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from quern.llm.common import documents, sliced, stable

CHUNK = 1 << 16
OVERLAP = 512
_CHARS_AT_ONCE = 1 << 22


def public_ranks(name: str = "byte_bpe_50k.tiktoken") -> tuple[str, str]:
    """Rank file and the pattern that cuts pre-tokens."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def encoding(ranks: str, pattern: str):
    import base64

    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def _lists(ids: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, np.int32), *ids])))


def _encoder(ranks: str, pattern: str, names: list[str]) -> Callable:
    """Replaces the last column, a text, by its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(ranks, pattern).encode_ordinary
        for batch in sliced(batches):
            texts, start, size, ids = batch.column(len(names) - 1).to_pylist(), 0, 0, []
            for i, text in enumerate(texts, 1):
                ids.append(np.array(encode(text or ""), np.int32))
                size += len(text or "")
                if size >= _CHARS_AT_ONCE or i == len(texts):
                    kept = [c.slice(start, i - start) for c in batch.columns[:-1]]
                    yield pa.RecordBatch.from_arrays([*kept, _lists(ids)], names)
                    start, size, ids = i, 0, []

    return run


def _cut(chunk: int, overlap: int) -> Callable:
    """Chunks of each text: a step of ``chunk`` characters and ``overlap`` more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                starts = range(0, max(1, len(text) - overlap), chunk)
                for i, start in enumerate(starts):
                    end = start + chunk + overlap if i + 1 < len(starts) else len(text)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row], pa.int64()), pa.array([i], pa.int32()), pa.array([start], pa.int64()),
                         pa.array([i + 1 == len(starts)]), pa.array([text[start:end]])],
                        ["row", "chunk", "start", "final", "part"],
                    )

    return run


def boundaries(text: str, pattern) -> np.ndarray:
    """Starts of pre-tokens that follow a character that is not blank and that no cut at the end can move."""
    starts = np.array([m.start() for m in pattern.finditer(text)], np.int64)
    return starts[[0 < p <= len(text) - 2 and not text[p - 1].isspace() for p in starts.tolist()]]


def _zones(pattern: str, chunk: int, overlap: int) -> Callable:
    """Boundaries of each chunk in the overlaps with its neighbours, as places in the whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        compiled = regex.compile(pattern)
        for batch in batches:
            left, right = [], []
            for start, text in zip(batch.column(2).to_pylist(), batch.column(4).to_pylist()):
                found = boundaries(text, compiled)
                left.append((found[found < overlap] + start).tolist())
                right.append((found[found >= chunk] + start).tolist())
            kept = [batch.column(i) for i in range(4)]
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (left, right)]
            yield pa.RecordBatch.from_arrays([*kept, *lists], ["row", "chunk", "start", "final", "left", "right"])

    return run


def _long(texts: DataFrame, ranks: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """``doc_id, ids`` of texts of several chunks."""
    rows = stable(texts.withColumn("row", F.monotonically_increasing_id()))
    parts = rows.select("row", "text").mapInArrow(
        _cut(chunk, overlap), "row bigint, chunk int, start bigint, final boolean, part string"
    )
    parts = parts.repartition("row", "chunk")
    zones = parts.mapInArrow(
        _zones(pattern, chunk, overlap),
        "row bigint, chunk int, start bigint, final boolean, left array<bigint>, right array<bigint>",
    )
    order = W.partitionBy("row").orderBy("chunk")
    before = F.lag("right").over(order)
    met = zones.withColumn("met", F.array_min(F.array_intersect("left", before)))
    cuts = met.select(
        "row",
        "chunk",
        F.coalesce("met", "start").alias("low"),
        F.coalesce(F.lead("met").over(order), F.lead("start").over(order)).alias("high"),
        F.count("met").over(order).alias("piece"),
    )
    # a chunk gives one slice; pieces are one slice, or more where an overlap had no common boundary
    size = F.coalesce(F.col("high") - F.col("low"), F.length("part")).cast("int")
    slices = parts.join(cuts, ["row", "chunk"]).select(
        "row", "piece", "chunk", F.substring("part", (F.col("low") - F.col("start") + 1).cast("int"), size).alias("slice")
    )

    def in_order(first: str, second: str):
        return F.transform(F.array_sort(F.collect_list(F.struct(first, second))), lambda x: x[second])

    pieces = slices.groupBy("row", "piece").agg(F.array_join(in_order("chunk", "slice"), "").alias("text"))
    names = ["row", "piece", "ids"]
    encoded = pieces.select("row", "piece", "text").mapInArrow(
        _encoder(ranks, pattern, names), "row bigint, piece bigint, ids array<int>"
    )
    whole = encoded.groupBy("row").agg(F.flatten(in_order("piece", "ids")).alias("ids"))
    return rows.select("row", "doc_id").join(whole, "row").select("doc_id", "ids")


def encode(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ranks: str | None = None,
    pattern: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """``doc_id, ids`` of every row. Texts of one chunk have nothing to stitch and are not shuffled."""
    public = public_ranks() if ranks is None or pattern is None else None
    ranks, pattern = ranks or public[0], pattern or public[1]
    texts = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    several = F.length("text") > chunk + overlap
    schema = T.StructType([texts.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    short = texts.filter(~several).mapInArrow(_encoder(ranks, pattern, ["doc_id", "ids"]), schema)
    return short.unionByName(_long(texts.filter(several), ranks, pattern, chunk, overlap))


def decode(
    encoded: DataFrame, ids: str = "ids", out: str = "bytes", ranks: str | None = None, pattern: str | None = None
) -> DataFrame:
    """Adds the bytes of a list of ids; a column of that name is replaced, null ids give null."""
    public = public_ranks() if ranks is None or pattern is None else None
    ranks, pattern = ranks or public[0], pattern or public[1]
    kept = [c for c in encoded.columns if c.lower() != out.lower()]
    at = kept.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        join = encoding(ranks, pattern).decode_bytes
        for batch in batches:
            lists = batch.column(at)
            values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
            ok = lists.is_valid().to_pylist()
            raw = [join(values[a:b].tolist()) if v else None for a, b, v in zip(offsets, offsets[1:], ok)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.binary())], [*kept, out])

    schema = T.StructType([*[encoded.schema[c] for c in kept], T.StructField(out, T.BinaryType())])
    return encoded.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, schema)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode(encode(documents(spark, sf_dir))).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
