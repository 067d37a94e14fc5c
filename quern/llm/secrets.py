"""Secret scans: fixed patterns, and runs of characters that look random rather than named.

Two character Markov chains are trained: one of random strings, one of ordinary
identifiers. Every run of secret characters is scored, whatever its length and characters;
what a fixed pattern finds in it is cut out and the pieces left are runs of their own. A run
is reported when its log-likelihood ratio between the two chains outweighs the prior odds.
Labelled samples come from the corpus itself: values that the fixed patterns find are
random, every other run of the texts is ordinary.

Defined results: a null or empty text has no spans; repeated rows are scanned each on their
own; an empty table gives no rows, and a model without samples falls back to its uniform
prior; other columns are kept as they are, only the output column replaces one of its name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quern.llm.common import SPANS, documents, sliced, span_digest, span_text, with_arrow_column

KINDS = ("assign", "access", "hex", "markov")

ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")

#: Characters of the chains; every other character ends a run and has symbol 0.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SYMBOLS = len(ALPHABET) + 1
_UPPER, _LOWER = slice(1, 27), slice(27, 53)  # symbols of capitals and of small letters
HEXADECIMAL = "0123456789abcdef"


def _symbol_table() -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for i, c in enumerate(ALPHABET):
        table[ord(c)] = i + 1
    return table


def symbols(text: str, table: np.ndarray) -> np.ndarray:
    """Symbol of each code point; those outside Latin-1 become a separator like any other."""
    return table[np.frombuffer(text.encode("latin-1", "replace").replace(b"?", b" "), np.uint8)]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the fixed patterns, kind by its place in ``KINDS``."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


@dataclass(frozen=True)
class Model:
    """``ratio[a, b]``: log-likelihood ratio, random against ordinary, of symbol b after a.

    ``prior``: log odds that an ordinary run must be outweighed by. Short runs are mostly
    words, so each character that a run has less than ``full`` adds ``short`` to them.
    """

    ratio: np.ndarray
    prior: float = 14.0
    full: int = 16
    short: float = 0.5

    def spans(self, text: str, table: np.ndarray) -> list[tuple[int, int, int]]:
        found = base_spans(text)
        s = symbols(f" {text} ", table).astype(np.int32)
        for start, _, end in found:
            s[start + 1 : end + 1] = 0  # the rest of the run is scored as pieces
        edges = np.flatnonzero(np.diff(s > 0))
        starts, ends = edges[::2], edges[1::2]
        if len(starts):
            score = np.add.reduceat(self.ratio.ravel().take(s[:-1] * SYMBOLS + s[1:]), starts)
            odds = self.prior + self.short * np.maximum(0, self.full - (ends - starts))
            found += [(int(starts[i]), 3, int(ends[i])) for i in np.flatnonzero(score > odds)]
        return sorted(found)


def _transitions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of symbol pairs of one task, for both labels: at most 2 * SYMBOLS**2 rows."""
    table, size = _symbol_table(), SYMBOLS * SYMBOLS
    counts = np.zeros(2 * size, np.int64)
    for batch in sliced(batches):
        for text in batch.column(0).to_pylist():
            if not text:
                continue
            s = symbols(f" {text} ", table).astype(np.int64)
            label = np.zeros(len(s) - 1, np.int64)
            for start, kind, end in base_spans(text):
                if kind == 0:  # the value alone, not the name it is assigned to
                    start = end - len(ASSIGN.match(text, start).group(2))
                label[start : end + 1] = size
            counts += np.bincount(s[:-1] * SYMBOLS + s[1:] + label, minlength=2 * size)
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(counts[seen])], ["cell", "n"])


def _compounds(ordinary: np.ndarray) -> np.ndarray:
    """Chances of the next symbol in names put together from ordinary words, like camelCase.

    After a small letter a word begins with a capital; capitals go on as small letters do.
    """
    begin = ordinary[0, _UPPER] + ordinary[0, _LOWER] + 0.5
    folded = ordinary[_UPPER, _UPPER] + ordinary[_UPPER, _LOWER] + ordinary[_LOWER, _LOWER] + 0.5
    chances = np.zeros((SYMBOLS, SYMBOLS))
    chances[_LOWER, _UPPER] = begin / begin.sum()
    chances[_UPPER, _UPPER] = folded / folded.sum(1, keepdims=True)
    return chances


def train(docs: DataFrame, text: str = "text", prior: float = 14.0, weight: float = 2000.0, compound: float = 0.01) -> Model:
    """Fits both chains on all texts; the driver gets one count per pair of symbols and label.

    ``weight`` is the size of the prior of the random chain, half uniform over the whole
    alphabet and half over hexadecimal digits, so that kinds of secrets the corpus does not
    show are not taken for impossible. ``compound`` is the chance that an ordinary letter is
    followed as in names made of several words, which a corpus of prose does not show.
    """
    rows = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(_transitions, "cell int, n bigint")
    counts = np.zeros(2 * SYMBOLS * SYMBOLS)
    for row in rows.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        counts[row.cell] = row.n
    ordinary, random = counts.reshape(2, SYMBOLS, SYMBOLS)
    uniform = np.zeros(SYMBOLS)
    uniform[1:] = 0.5 / len(ALPHABET)
    for c in HEXADECIMAL:
        uniform[ALPHABET.index(c) + 1] += 0.5 / len(HEXADECIMAL)
    # inside a run only: the separator is no successor
    random, ordinary = random.copy(), ordinary.copy()
    random[:, 0] = ordinary[:, 0] = 0
    random = random + weight * uniform
    compounds = _compounds(ordinary)
    ordinary = ordinary + 0.5
    ordinary[:, 0] = random[:, 0] = 1e-9
    ordinary /= ordinary.sum(1, keepdims=True)
    letters = slice(_UPPER.start, _LOWER.stop)
    ordinary[letters] = (1 - compound) * ordinary[letters] + compound * compounds[letters]
    ratio = np.log(random / random.sum(1, keepdims=True)) - np.log(ordinary)
    ratio[:, 0] = 0
    return Model(ratio, prior)


def find(docs: DataFrame, model: Model, text: str = "text", out: str = "secrets") -> DataFrame:
    """Adds ``out``: all spans by start, then kind; positions count code points, ends are exclusive."""
    kind = T._parse_datatype_string(SPANS)

    def make():
        table, names = _symbol_table(), list(KINDS)

        def scan(texts: list) -> pa.Array:
            return pa.array(
                [
                    [{"kind": names[k], "start": s, "end": e} for s, k, e in model.spans(t or "", table)]
                    for t in texts
                ],
                pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])),
            )

        return scan

    return with_arrow_column(docs, text, out, kind, make)


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each stretch of spans replaced by a mark; overlapping spans are one stretch."""
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))

    def step(state: Column, s: Column) -> Column:
        put = F.concat(
            state["done"], F.substring(text, state["at"] + 1, s["start"] - state["at"]), F.lit(mark)
        )
        return (
            F.when(s["start"] >= state["at"], F.struct(put.alias("done"), s["end"].alias("at")))
            .otherwise(F.struct(state["done"].alias("done"), F.greatest(state["at"], s["end"]).alias("at")))
        )

    cut = F.aggregate(spans, start, step, lambda s: F.concat(s["done"], F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, cut).otherwise(text)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    spans = F.col("secrets")
    base = F.filter(spans, lambda s: s["kind"] != "markov")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")

    return find(docs, train(docs)).select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS],
        span_digest(base).alias("base_sha256"),
        span_text(spans).alias("spans"),
    )
