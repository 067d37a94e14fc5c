"""Packs tokenised documents into sequences: cutting stock by column generation.

Documents are cut into pieces of at most one sequence. The histogram of piece lengths, in
units of a few tokens, is all the driver sees: a linear program chooses how often to use
each pattern of lengths, a knapsack by dynamic programming prices new patterns, the rounded
patterns are completed by best fit, and Spark assigns every piece by its rank among those
of its length.

Defined results: a null or empty text is the end mark alone; repeated rows and rows with a
null id are packed each on their own; an empty table gives no rows; other columns are
ignored by ``packed`` and cannot clash.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from quern.llm.common import documents, kept_in_worker, sliced, stable

LENGTH = 2048
UNIT = 8
END = 1
BUNDLE_BITS = 12  # groups of ranks in a bundle: 2**12
_CHARS_AT_ONCE = 1 << 22
_WORDS, _PARTS = 400_000, 500_000  # that a worker remembers
_BREAK = b"\xff" * 4


def public_vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Ids of whole texts, each distinct word between blanks encoded once and remembered.

    The vocabulary's rules drop blanks and never look across them, so the ids of a text are
    those of its words. Words of Latin letters, digits and signs are lowered and cut by the
    vocabulary's pattern first, and their parts are remembered too; new parts are encoded as
    long strings with blanks between them and told apart by the tokens that end a part.
    Other words, and words with a special token's own characters, go to the library as they
    are, one by one. Ids are kept as bytes of unsigned 32-bit integers.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        # letters that one lower-case letter replaces and that compose with nothing
        self.plain = regex.compile(r"[\x21-\x7e\u00c0-\u012f\u0131-\u024f]+")
        self.cut = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+|\n")
        self.words: dict[str, bytes] = {"": b""}
        self.parts: dict[str, bytes] = {"\n": _BREAK}

    def _is_plain(self, text: str) -> bool:
        return self.plain.fullmatch(text) is not None and not any(mark in text for mark in self.special)

    def _encode(self, strings: list[str]) -> list[np.ndarray]:
        encoded = self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in encoded]

    def _learn_parts(self, parts: list[str]) -> None:
        groups = [parts[i : i + 1000] for i in range(0, len(parts), 1000)]
        for group, ids in zip(groups, self._encode([" ".join(g) for g in groups])):
            stops = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(stops) == len(group):
                raw = ids.tobytes()
                self.parts.update(zip(group, (raw[a:b] for a, b in zip([0, *stops], stops))))
            else:
                self.parts.update((p, i.tobytes()) for p, i in zip(group, self._encode(group)))

    def _learn(self, words: list[str]) -> None:
        if len(self.words) > _WORDS:
            self.words = {"": b""}
        if len(self.parts) > _PARTS:
            self.parts = {"\n": _BREAK}
        other = []
        if not self._is_plain("".join(words)):
            other = [w for w in words if not self._is_plain(w)]
            words = [w for w in words if self._is_plain(w)]
        parts = self.cut.findall("\n".join(words).lower())
        self._learn_parts(list(set(parts).difference(self.parts)))
        # no id has four bytes of 255 in it or across its end, so a break is found where it was put
        self.words.update(zip(words, b"".join(map(self.parts.__getitem__, parts)).split(_BREAK)))
        self.words.update((w, ids.tobytes()) for w, ids in zip(other, self._encode(other)))

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each with the end mark, and where each text ends."""
        split = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        coded = split.values.dictionary_encode()
        words = coded.dictionary.to_pylist()
        ids = list(map(self.words.get, words))
        new = [i for i, x in enumerate(ids) if x is None]
        if new:
            self._learn([words[i] for i in new])
            for i in new:
                ids[i] = self.words[words[i]]
        ids.append(np.uint32(END).tobytes())
        # a batch has less than 2**31 ids: it is bounded in characters, or one text
        sizes = np.fromiter(map(len, ids), np.int32, len(ids)) >> 2
        flat, begins = np.frombuffer(b"".join(ids), np.uint32), np.cumsum(sizes, dtype=np.int32) - sizes
        stops = split.offsets.to_numpy()[1:]
        code = np.insert(coded.indices.to_numpy(), stops, len(words))
        size = sizes[code]
        upto = np.cumsum(size, dtype=np.int32)
        place = np.repeat(begins[code] - (upto - size), size)
        place += np.arange(len(place), dtype=np.int32)
        result, upto = flat[place], upto.astype(np.int64)
        return result, upto[stops + np.arange(len(stops))]


def _slices(texts: list[str]) -> Iterator[list[int]]:
    part, size = [], 0
    for i, t in enumerate(texts):
        part.append(i)
        size += len(t)
        if size >= _CHARS_AT_ONCE:
            yield part
            part, size = [], 0
    if part:
        yield part


_PIECES = "start bigint, length bigint, doc_tokens bigint, ids_crc32 bigint"


def pieces(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
    vocabulary: str | None = None, with_ids: bool = True,
) -> DataFrame:
    """Rows ``doc_id, start, length, doc_tokens, ids_crc32`` and, if wanted, ``ids`` of each piece."""
    path = vocabulary or public_vocabulary()
    schema = docs.select(F.col(f"`{doc_id}`").alias("doc_id")).schema.simpleString()[7:-1].replace(":", " ", 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = kept_in_worker(("WordEncoder", path), lambda: WordEncoder(path))
        for batch in sliced(batches, 4096):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for part in _slices(texts):
                ids, ends = encode([texts[i] for i in part])
                yield _cut(batch.column(0), part, ids, ends)

    def _cut(keys: pa.Array, part: list[int], ids: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
        begins = np.concatenate([[0], ends[:-1]])
        total = ends - begins
        n = -(-total // length)
        own = np.repeat(np.arange(len(part)), n)
        start = (np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)) * length
        first = begins[own] + start
        last = np.minimum(first + length, ends[own])
        raw = ids.astype("<u4")
        crc = [zlib.crc32(raw[a:b]) for a, b in zip(first.tolist(), last.tolist())]
        columns = [
            keys.take(pa.array(np.asarray(part)[own])), pa.array(start), pa.array(last - first),
            pa.array(total[own]), pa.array(crc, pa.int64()),
        ]
        names = ["doc_id", "start", "length", "doc_tokens", "ids_crc32"]
        if with_ids:
            offsets = pa.array(np.append(first, ends[-1:]).astype(np.int32))
            columns.append(pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names)

    wanted = f"{schema}, {_PIECES}" + ", ids array<int>" * with_ids
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(run, wanted)


@dataclass
class Plan:
    """Patterns of piece sizes in units, each with the number of sequences that follow it."""

    patterns: list[tuple[dict[int, int], int]] = field(default_factory=list)

    @property
    def sequences(self) -> int:
        return sum(n for _, n in self.patterns)

    def places(self) -> list[tuple[int, int, int, int, int]]:
        """``units, rank_from, rank_to, each, first_sequence``: where pieces of a size go by rank."""
        used: Counter[int] = Counter()
        rows, sequence = [], 0
        for pattern, n in self.patterns:
            for units, each in pattern.items():
                rows.append((units, used[units], used[units] + each * n, each, sequence))
                used[units] += each * n
            sequence += n
        return rows


def _price(value: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack by dynamic programming: the best pattern and its value."""
    worth = np.full(capacity + 1, -np.inf)
    worth[sizes] = value
    item = np.zeros(capacity + 1, int)
    item[sizes] = np.arange(len(sizes))
    best, taken = np.zeros(capacity + 1), np.zeros(capacity + 1, int)
    for c in range(1, capacity + 1):
        options = best[c - 1 :: -1][:c] + worth[1 : c + 1]
        k = options.argmax()
        if options[k] > best[c - 1]:
            best[c], taken[c] = options[k], k + 1
        else:
            best[c] = best[c - 1]
    pattern, c = np.zeros(len(sizes)), capacity
    while c > 0:
        if taken[c]:
            pattern[item[taken[c]]] += 1
            c -= taken[c]
        else:
            c -= 1
    return best[capacity], pattern


def column_generation(
    demand: dict[int, int], capacity: int, rounds: int = 5_000, tolerance: float = 2e-3, smoothing: float = 0.95
) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often to use each, fractional: revised simplex with priced columns.

    Prices are smoothed towards the best dual point so far, which takes fewer rounds, and
    demands are raised by less than a thousandth of a piece, so that no pivot stands still.
    It ends when the sequences are within ``tolerance`` of the dual bound on their number.
    """
    sizes = np.array(sorted(demand))
    b = np.array([demand[s] for s in sizes]) + 1e-3 * np.random.default_rng(0).random(len(sizes))
    base = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1 / np.diag(base))
    x = inverse @ b
    bound, centre = 0.0, None
    for turn in range(rounds):
        price = inverse.sum(0)
        tried = price if centre is None else smoothing * centre + (1 - smoothing) * price
        value, pattern = _price(tried, sizes, capacity)
        if b @ tried / value > bound:
            bound, centre = b @ tried / value, tried / value
        if price @ pattern <= 1 + 1e-9 and centre is not None:
            value, pattern = _price(price, sizes, capacity)
            if b @ price / value > bound:
                bound, centre = b @ price / value, price / value
        if x.sum() <= bound * (1 + tolerance) or price @ pattern <= 1 + 1e-9:
            break
        change = inverse @ pattern
        rising = change > 1e-9
        ratio = np.full(len(x), np.inf)
        ratio[rising] = x[rising] / change[rising]
        out = ratio.argmin()
        base[:, out] = pattern
        row = inverse[out] / change[out]
        inverse -= np.outer(change, row)
        inverse[out] = row
        if turn % 100 == 99:
            # one Newton step against drift; einsum, as threads of a linear algebra library may block beside a JVM
            product = np.einsum("ij,jk->ik", base, inverse)
            inverse = 2 * inverse - np.einsum("ij,jk->ik", inverse, product)
        x = np.maximum(inverse @ b, 0)
    return [(base[:, j], x[j]) for j in range(len(x))]


def _best_fit(left: dict[int, int], capacity: int) -> list[dict[int, int]]:
    """Sequences for the pieces that rounding left over, largest first into the tightest space."""
    by_space: dict[int, list[Counter]] = {}
    for units in sorted(left, reverse=True):
        for _ in range(left[units]):
            space = next((s for s in range(units, capacity + 1) if by_space.get(s)), None)
            pattern = by_space[space].pop() if space is not None else Counter()
            pattern[units] += 1
            by_space.setdefault((capacity if space is None else space) - units, []).append(pattern)
    return [dict(p) for ps in by_space.values() for p in ps]


def plan(demand: dict[int, int], capacity: int) -> Plan:
    """Whole numbers of patterns that take every piece of a histogram ``{units: pieces}``."""
    left = dict(demand)
    if not left:
        return Plan()
    sizes = sorted(left)
    result = Plan()
    for pattern, times in column_generation(left, capacity):
        n = int(times + 1e-6)
        use = {u: int(k) for u, k in zip(sizes, pattern) if k}
        n = min([n, *[left[u] // k for u, k in use.items()]])
        if n > 0:
            result.patterns.append((use, n))
            for u, k in use.items():
                left[u] -= k * n
    more = Counter(tuple(sorted(p.items())) for p in _best_fit({u: n for u, n in left.items() if n}, capacity))
    result.patterns += [(dict(p), n) for p, n in more.items()]
    return result


def assigned(cut: DataFrame, length: int = LENGTH, unit: int = UNIT, group_rows: int = 500) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces that have a ``length``.

    Pieces are written with a number of their own and ranked within their size by counting
    groups of about ``group_rows`` such numbers first, and bundles of groups before those, so
    a frequent size is never sorted in one task, nor are its groups.
    """
    spark = cut.sparkSession
    rows = stable(
        cut.withColumns({"_row": F.monotonically_increasing_id(), "_units": F.ceil(F.col("length") / unit).cast("int")})
    )
    histogram = {r._units: r.n for r in rows.groupBy("_units").agg(F.count("*").alias("n")).collect()}
    places = plan(histogram, length // unit).places()
    places = spark.createDataFrame(places, "_units int, _from bigint, _to bigint, _each int, _first bigint")
    # a row for each size, so at most length / unit rows
    parts = spark.createDataFrame([(u, -(-n // group_rows)) for u, n in histogram.items()], "_units int, _parts bigint")
    rows = rows.join(F.broadcast(parts), "_units").withColumn("_group", F.pmod(F.xxhash64("_row"), "_parts"))
    bundle = F.shiftright("_group", BUNDLE_BITS).alias("_bundle")
    sizes = rows.groupBy("_units", "_group").agg(F.count("*").alias("_n")).withColumn("_bundle", bundle)

    def upto(order: str, *by: str) -> Column:
        return F.coalesce(F.sum("_n").over(W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))

    bundles = sizes.groupBy("_units", "_bundle").agg(F.sum("_n").alias("_n"))
    bundles = bundles.select("_units", "_bundle", upto("_bundle", "_units").alias("_begin"))
    offsets = sizes.withColumn("_before", upto("_group", "_units", "_bundle")).join(bundles, ["_units", "_bundle"])
    offsets = offsets.select("_units", "_group", (F.col("_before") + F.col("_begin")).alias("_before"))
    within = W.partitionBy("_units", "_group").orderBy("_row")
    ranked = rows.withColumn("_rank", F.row_number().over(within) - 1).join(offsets, ["_units", "_group"])
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_before"))
    # as many rows as patterns have sizes, and there are no more patterns than sizes twice over
    put = ranked.join(F.broadcast(places), "_units").filter("_rank >= _from and _rank < _to")
    put = put.withColumn(
        "sequence_id", F.col("_first") + F.floor((F.col("_rank") - F.col("_from")) / F.col("_each"))
    )
    order = W.partitionBy("sequence_id").orderBy(F.desc("_units"), "_rank").rowsBetween(W.unboundedPreceding, 0)
    return put.withColumn("offset", F.sum("length").over(order) - F.col("length")).select(
        *cut.columns, "sequence_id", "offset"
    )


def packed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_ids: bool = True, **settings) -> DataFrame:
    """Pieces of all documents with their sequence and place in it."""
    return assigned(pieces(docs, doc_id, text, with_ids=with_ids), **settings)


def op10_digest(docs: DataFrame) -> DataFrame:
    return packed(docs, with_ids=False).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_digest(documents(spark, sf_dir))
