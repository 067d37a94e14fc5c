"""Language identification: each text is a mixture of languages, weighed by its letter trigrams.

Trigram counts of every language are learned from labelled texts. For a text,
expectation-maximisation estimates the share of each language, the words being drawn from
the mixture with their trigram likelihoods; the set of languages is the nested one with the
best penalised likelihood, and the prediction is the language with the largest share.

Defined results: a null text or one without a letter is ``und`` with score 0, and so is any
text if nothing could be learned; ties go to the first language by name; rows with a null
language are not learned from; repeated rows count each time; an empty table gives no rows;
other columns stay, only the output columns replace those of their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quern.llm.common import documents, sliced, with_arrow_column

BUCKETS = 1 << 16
UNKNOWN = "und"
_LETTERS_TO = 0x32400  # the end of the last block with letters
_LANGUAGES_AT_ONCE = 64
_CHARS_AT_ONCE = 1 << 19


def letter_table() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(_LETTERS_TO)] + [False])


def grams(texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram bucket around every letter, and the first letter and the text of every word.

    Letters are lowered; anything else is one blank. Word starts index the buckets.
    """
    lowered = [t.lower() for t in texts]
    points = np.frombuffer("".join(f" {t} " for t in lowered).encode("utf-32-le"), "<u4")
    is_letter = letters[np.minimum(points, _LETTERS_TO)]
    points = np.where(is_letter, points, 32).astype(np.uint32)
    at = np.flatnonzero(is_letter)
    hashed = points[at - 1] * np.uint32(0x9E3779B1)
    hashed ^= points[at] * np.uint32(0x85EBCA6B)
    hashed = hashed * np.uint32(0xC2B2AE35) + points[at + 1] * np.uint32(0x27D4EB2F)
    hashed ^= hashed >> np.uint32(15)
    hashed *= np.uint32(0x2C1B3C6D)
    words = np.flatnonzero(~is_letter[at - 1])
    ends = np.cumsum([len(t) + 2 for t in lowered])
    return (hashed >> np.uint32(16)).astype(np.int64), words, np.searchsorted(ends, at[words], "right")


def _pieces(texts: list[str], chars: int) -> Iterator[slice]:
    """Slices of texts of about so many characters together."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts by language of one task."""
    letters = letter_table()
    counts: dict[str, np.ndarray] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for lang, n in counts.items():
            seen = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(seen), pa.string()), pa.array(seen, pa.int32()), pa.array(n[seen])],
                ["lang", "bucket", "n"],
            )

    for batch in sliced(batches):
        by_lang: dict[str, list[str]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            if lang not in counts and len(counts) >= _LANGUAGES_AT_ONCE:
                yield from rows()
                counts.clear()
            own = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
            for piece in _pieces(texts, _CHARS_AT_ONCE):
                own += np.bincount(grams(texts[piece], letters)[0], minlength=BUCKETS)
    yield from rows()


@dataclass(frozen=True)
class Model:
    """``log_p[l, b]``: log probability of trigram bucket b in language l."""

    languages: tuple[str, ...]
    log_p: np.ndarray


def train(docs: DataFrame, text: str = "text", lang: str = "lang", smoothing: float = 0.5, most: int = 1000) -> Model:
    """Learns from all rows with a text and a language.

    The driver gets 65,536 counts for each of the ``most`` languages with the most rows, more
    than there are with texts to learn from; texts are never collected.
    """
    rows = docs.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text")).dropna()
    common = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most)
    rows = rows.join(F.broadcast(common.select("lang")), "lang")  # at most that many rows
    counted = rows.mapInArrow(_counts, "lang string, bucket int, n bigint")
    table = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names, index = np.unique(table["lang"].to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
    n = np.zeros((len(names), BUCKETS))
    n[index, table["bucket"].to_numpy()] = table["n"].to_numpy()
    p = (n + smoothing) / (n.sum(1, keepdims=True) + smoothing * BUCKETS)
    return Model(tuple(map(str, names)), np.log(p).astype(np.float32))


def _shares(
    likely: np.ndarray, doc: np.ndarray, first: np.ndarray, allowed: np.ndarray, rounds: int, moved: float
) -> tuple:
    """EM: shares of the allowed languages in each text, and the log of the mixture by word.

    A text is done when none of its own shares moves by ``moved``, whatever texts stand beside it.
    """
    n = np.diff(np.append(first, len(doc)))[:, None]
    share = allowed / allowed.sum(1, keepdims=True, dtype=np.float64)
    live, own, size = np.arange(len(first)), likely, n  # texts that still move, and their words
    for _ in range(rounds):
        start = np.cumsum(size) - size[:, 0]
        old = share[live]
        part = own * np.repeat(old, size[:, 0], 0)
        part /= part.sum(1, keepdims=True)
        share[live] = new = np.add.reduceat(part, start) / size
        moving = np.abs(new - old).max(1) >= moved
        if not moving.all():
            own = own[np.repeat(moving, size[:, 0])]
            live, size = live[moving], size[moving]
        if not len(live):
            break
    return share, np.log((likely * share[doc]).sum(1))


def mixtures(
    texts: list[str], model: Model, letters: np.ndarray, penalty: float = 5.0, rounds: int = 200, moved: float = 1e-4
) -> np.ndarray:
    """Shares of the languages in each text, zero outside the set chosen; all zero without a letter.

    Sets are nested in order of the shares among all languages; a language must raise the
    log-likelihood by ``penalty`` times the log of one more than the number of words. Sets
    of any size count; a text is left when no larger set can be better. The shares of a
    text do not depend on the other texts.
    """
    result = np.zeros((len(texts), len(model.languages)), np.float32)
    bucket, word, doc = grams(texts, letters)
    if not len(word) or not len(model.languages):
        return result
    log_word = np.stack([np.add.reduceat(row[bucket], word) for row in model.log_p], 1)
    top = log_word.max(1, keepdims=True)
    likely = np.maximum(np.exp(log_word - top), 1e-30)
    present, doc = np.unique(doc, return_inverse=True)
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    size = np.diff(np.append(first, len(doc)))
    cost = penalty * np.log1p(size)
    share, log_mix = _shares(likely, doc, first, np.ones((len(present), likely.shape[1]), np.float32), rounds, moved)
    order = np.argsort(-share, 1, kind="stable")
    # the log-likelihood is concave in the shares: no mixture is above this limit
    slope = np.add.reduceat(likely / np.exp(log_mix)[:, None], first).max(1) / size
    limit = np.add.reduceat(log_mix.astype(np.float64), first) + size * np.log(np.maximum(slope, 1))
    best = np.full(len(present), -np.inf)
    chosen = np.zeros(share.shape, np.float32)
    left = np.arange(len(present))  # texts that a larger set may fit better
    for k in range(1, likely.shape[1] + 1):
        allowed = np.zeros((len(left), likely.shape[1]), np.float32)
        np.put_along_axis(allowed, order[left, :k], 1, 1)
        own, log_mix = _shares(likely, doc, first, allowed, rounds, moved)
        value = np.add.reduceat(log_mix.astype(np.float64), first) - (k - 1) * cost[left]
        better = value > best[left]
        best[left[better]], chosen[left[better]] = value[better], own[better]
        more = limit[left] - k * cost[left] > best[left]
        if not more.any():
            break
        likely, left, size = likely[more[doc]], left[more], size[more]
        doc, first = np.repeat(np.arange(len(left)), size), np.cumsum(size) - size
    result[present] = chosen
    return result


_OUT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def predict(docs: DataFrame, model: Model, text: str = "text", out: str = "language", **settings) -> DataFrame:
    """Adds the struct ``out``: ``lang_pred`` and its share of the text as ``score``."""
    names = [*model.languages, UNKNOWN]
    at_once = _CHARS_AT_ONCE * 4 // max(4, len(names))

    def make():
        letters = letter_table()

        def fn(values: list) -> pa.Array:
            texts = [t or "" for t in values]
            parts = [mixtures(texts[p], model, letters, **settings) for p in _pieces(texts, at_once)]
            shares = np.concatenate([np.zeros((0, len(names) - 1), np.float32), *parts])
            shares = np.column_stack([shares, np.zeros(len(texts))])  # the last is no language
            best = shares.argmax(1)
            score = shares[np.arange(len(texts)), best]
            best[score == 0] = len(names) - 1
            return pa.StructArray.from_arrays(
                [pa.array([names[b] for b in best], pa.string()), pa.array(np.minimum(score, 1.0), pa.float64())],
                ["lang_pred", "score"],
            )

        return fn

    return with_arrow_column(docs, text, out, _OUT, make)


def held_out(doc_id: Column) -> Column:
    """The fold that is never learned from; a null id is not in it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learnable(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Rows outside the held-out fold whose id is known."""
    key = F.col(f"`{doc_id}`")
    return docs.filter(key.isNotNull() & ~held_out(key))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = train(learnable(docs))
    predicted = predict(docs.select("doc_id", "text"), model)
    return predicted.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "language.lang_pred", "language.score"
    )
