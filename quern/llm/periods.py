"""Periodic runs of words: branching tandem repeats of an enhanced suffix array.

The words of many texts are sorted as one suffix array whose suffixes never leave their
text. An index of the array with LCP ``l`` splits its LCP interval in two; of the smaller
part, each suffix ``i`` asks the inverse array whether ``i + l`` or ``i - l`` lies in the
other part. If so, a square of period ``l`` ends where it cannot go on. Rotated to the left as
far as it goes, a square becomes a run; squares that a shorter period explains are merged
into it. There are no tree nodes: intervals are ranges of ranks, and all steps are array
operations over all texts of a batch.

Defined results: a null text is an empty one and has no runs; a word is dropped from the
collapsed text if any run holds it after the run's first period; texts are judged one by one,
so repeated rows and other columns do not matter; an empty table gives no rows. A task holds
the suffix array of one text at least, whatever its length: about 250 bytes a word for a text
of a million words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quern.llm.common import documents, let, with_arrow_column

LEAST_WORDS = 6
LEAST_PERIODS = 4
BATCH_WORDS = 150_000
_CHUNK = 1 << 20  # suffixes that ask the inverse array at a time

RUN = "struct<start:int,length:int,period:int>"


def suffixes(key: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and LCP array of ``key`` by doubling; exact for LCPs up to ``depth``, larger ones may be cut.

    Every text must end in a key that occurs once, and texts must not share keys. Each
    round sorts only the suffixes that are not yet alone with their first words.
    """
    n = len(key)
    sa = np.argsort(key, kind="stable")
    slots = np.arange(n)
    sorted_key, h, levels = key[sa], 1, []
    rank = np.empty(n, np.int32)
    while True:
        head = np.append(True, sorted_key[1:] != sorted_key[:-1])
        rank = rank.copy()
        rank[sa[slots]] = slots[np.maximum.accumulate(np.where(head, np.arange(len(slots)), 0))]
        levels.append(rank)
        slots = slots[~(head & np.append(head[1:], True))]
        if not len(slots) or h > depth:
            break
        at = sa[slots]
        sorted_key = rank[at].astype(np.int64) * n + rank[at + h]
        order = np.argsort(sorted_key)
        sa[slots], sorted_key, h = at[order], sorted_key[order], 2 * h
    lcp = np.zeros(n, np.int32)
    met = np.flatnonzero(levels[0][sa[1:]] == levels[0][sa[:-1]])
    a, b = sa[met], sa[met + 1]
    length = np.zeros(len(met), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        length += (levels[k][a + length] == levels[k][b + length]).astype(np.int64) << k
    lcp[met + 1] = length
    return sa, lcp


def _parts(lcp: np.ndarray, at: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """First rank of the part left of each index, and last rank of the part right of it.

    Left, LCPs exceed that of the index, right they reach it, so that of an interval with
    many children each pair of suffixes is parted by one index.
    """
    least = [lcp]  # of 1, 2, 4.. LCPs from a place on
    while 2 << len(least) - 1 <= longest:
        step = 1 << len(least) - 1
        last = least[-1]
        least.append(np.append(np.minimum(last[:-step], last[step:]), last[-step:]))
    own, n = lcp[at], len(lcp)
    low, high = at - 1, at.copy()
    for k in range(len(least) - 1, -1, -1):
        to = low - (1 << k)
        low = np.where((to >= 0) & (least[k][np.maximum(to, -1) + 1] > own), to, low)
        to = high + (1 << k)
        high = np.where((to < n) & (least[k][np.minimum(high + 1, n - 1)] >= own), to, high)
    return low, high


def _squares(sa: np.ndarray, lcp: np.ndarray, at: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Start and period of the squares that cannot go on to the right, for the periods ``lcp[at]``."""
    low, high = _parts(lcp, at, longest)
    isa = np.empty(len(sa), np.int32)
    isa[sa] = np.arange(len(sa))
    left = at - low <= high - at + 1
    first, size = np.where(left, low, at), np.where(left, at - low, high - at + 1)
    other_low, other_high = np.where(left, at, low), np.where(left, high, at - 1)
    total = np.cumsum(size)
    begin = 0
    while begin < len(at):
        end = max(begin + 1, int(np.searchsorted(total, total[begin] - size[begin] + _CHUNK, "right")))
        sizes = size[begin:end]
        of = np.repeat(np.arange(begin, end), sizes)
        rank = np.arange(len(of)) + np.repeat(first[begin:end] - (np.cumsum(sizes) - sizes), sizes)
        i, period = sa[rank], lcp[at[of]].astype(np.int64)
        lo, hi = other_low[of], other_high[of]
        for start, partner in ((i, i + period), (i - period, i - period)):
            there = isa[np.maximum(partner, 0)]
            hit = (partner >= 0) & (there >= lo) & (there <= hi)
            yield start[hit], period[hit]
        begin = end


def _rotations(key: np.ndarray, start: np.ndarray, period: np.ndarray, most: int | None = None) -> np.ndarray:
    """How many words before ``start`` equal the word a period later, in a row; counted up to ``most`` if given."""
    found, alive, width = np.zeros(len(start), np.int64), np.arange(len(start)), most or 8
    while len(alive):
        i = (start[alive] - found[alive])[:, None] - np.arange(1, width + 1)
        same = (i >= 0) & (key[np.maximum(i, 0)] == key[np.maximum(i, 0) + period[alive][:, None]])
        full = same.all(1)
        found[alive] += np.where(full, width, same.argmin(1))
        if most:
            break
        alive = alive[full]
        width = min(2 * width, max(8, _CHUNK // max(1, len(alive))))
    return found


def runs(key: np.ndarray, longest: int, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> np.ndarray:
    """Rows ``start, length, period`` of all runs, by start and period; ``key`` as in :func:`suffixes`.

    ``longest`` is the number of words of the longest text; ``least_periods`` is 2 at least.
    """
    deepest = longest // least_periods
    sa, lcp = suffixes(key, deepest)
    found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for start, period in _squares(sa, lcp, np.flatnonzero((lcp > 0) & (lcp <= deepest)), longest + 1):
        need = np.maximum(least_words, least_periods * period) - 2 * period
        near = _rotations(key, start, period, 2) >= np.minimum(need, 2)
        found.append((start[near], period[near]))
    start, period = (np.concatenate(x) for x in zip(*found))
    end = start + 2 * period
    order = np.lexsort((period, end))
    start, period, end = start[order], period[order], end[order]
    result = [np.empty((0, 3), np.int64)]
    while len(start):
        new = np.append(True, end[1:] != end[:-1])
        back = _rotations(key, start[new], period[new])
        length = 2 * period[new] + back
        long = length >= np.maximum(least_words, least_periods * period[new])
        result.append(np.column_stack([start[new] - back, length, period[new]])[long])
        # a square inside the run of a shorter period repeats that period
        other = ~new & (2 * period > length[np.cumsum(new) - 1])
        start, period, end = start[other], period[other], end[other]
    rows = np.concatenate(result)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()  # bytes split at ASCII blanks only


def _batches(texts: list) -> Iterator[list[list[bytes]]]:
    held, count = [], 0
    for text in texts:
        words = _words(text)
        if held and count + len(words) > BATCH_WORDS:
            yield held
            held, count = [], 0
        held.append(words)
        count += len(words)
    if held:
        yield held


def _judged(texts: list[list[bytes]]) -> Iterator[tuple[int, np.ndarray, bytes]]:
    """Number of words, runs and collapsed text of each text."""
    number: dict[bytes, int] = {}
    sizes = np.array([len(t) for t in texts])
    ids = np.fromiter((number.setdefault(w, len(number)) for t in texts for w in (*t, b" ")), np.int64, int(sizes.sum()) + len(texts))
    text = np.repeat(np.arange(len(texts)), sizes + 1)  # each text ends in a blank, which is no word
    rows = runs(text * len(number) + ids, int(sizes.max()))
    drop = np.zeros(len(ids) + 1, np.int64)
    np.add.at(drop, rows[:, 0] + rows[:, 2], 1)
    np.add.at(drop, rows[:, 0] + rows[:, 1], -1)
    stays = np.cumsum(drop) == 0
    begin = np.cumsum(sizes + 1) - sizes - 1
    bounds = np.searchsorted(rows[:, 0], [*begin, len(ids)])
    for k, words in enumerate(texts):
        own = rows[bounds[k] : bounds[k + 1]]
        if len(own):
            words = [words[i] for i in np.flatnonzero(stays[begin[k] : begin[k] + sizes[k]])]
        yield int(sizes[k]), own - [begin[k], 0, 0], b" ".join(words)


def with_runs(docs: DataFrame, text: str = "text", out: str = "periods") -> DataFrame:
    """Adds ``struct<n_words, runs, collapsed>``: the runs by start and period, and the words that stay."""
    kind = T.StructType(
        [
            T.StructField("n_words", T.IntegerType()),
            T.StructField("runs", T.ArrayType(T._parse_datatype_string(RUN))),
            T.StructField("collapsed", T.StringType()),
        ]
    )

    def make():
        def judge(texts: list) -> pa.Array:
            counts, rows, left = [], [], []
            for batch in _batches(texts):
                for n, own, collapsed in _judged(batch):
                    counts.append(n)
                    rows.append(own)
                    left.append(collapsed)
            flat = np.concatenate([*rows, np.empty((0, 3), np.int64)])
            cells = pa.StructArray.from_arrays([pa.array(flat[:, c], pa.int32()) for c in range(3)], ["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)]), pa.int32()), cells)
            collapsed = pa.array(left, pa.binary()).cast(pa.string())
            return pa.StructArray.from_arrays([pa.array(counts, pa.int32()), lists, collapsed], ["n_words", "runs", "collapsed"])

        return judge

    return with_arrow_column(docs, text, out, kind, make)


def strongest(found: Column) -> Column:
    """The run with the most periods, compared exactly; the first of equal ones; null if there is none."""

    def better(a: Column, b: Column) -> Column:
        more = b["length"].cast("bigint") * a["period"] > a["length"].cast("bigint") * b["period"]
        return F.when(a.isNull() | more, b).otherwise(a)

    return F.reduce(found, F.lit(None).cast(RUN), better)


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: number of runs, the strongest one, and digests of runs and collapsed text."""
    judged = with_runs(docs.select("doc_id", "text"), "text", "found").select("doc_id", "found.runs", "found.collapsed")
    lines = F.transform("runs", lambda r: F.concat(*[x for c in ("start", "length", "period") for x in (r[c].cast("string"), F.lit("," if c != "period" else "\n"))]))
    best, length, period = F.col("best"), F.col("best.length").cast("bigint"), F.col("best.period").cast("bigint")
    return judged.withColumn("best", strongest(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), best["start"].cast("bigint").alias("start"), length.alias("length"),
        period.alias("period"), F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def damaged(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: a tenth of the texts repeat some of their words from a place on, as the id's checksum says."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split("text", r"[ \t\n\x0B\f\r]+"), lambda w: w != "")

    def repeated(w: Column) -> Column:
        n = F.size(w).cast("bigint")
        a = g % F.greatest(n, F.lit(1).cast("bigint"))
        p = 1 + F.floor((n - a) / (3 + g % 8))
        places = F.sequence(F.lit(0).cast("bigint"), F.greatest(n, F.lit(1).cast("bigint")) - 1)

        def moved(k: Column) -> Column:
            return F.transform(
                places, lambda i: F.get(k["w"], F.when(i < k["a"], i).otherwise(k["a"] + (i - k["a"]) % k["p"]).cast("int"))
            )

        text = let(F.struct(w.alias("w"), a.alias("a"), p.alias("p")), moved)
        return F.when(n > 0, F.array_join(text, " ")).otherwise(F.col("text"))

    return docs.select("doc_id", F.when(h % 10 == 0, let(words, repeated)).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(damaged(documents(spark, sf_dir)))


#: Any run repeats five words in a row a period later, so runs are stretches of such places.
OP12_SQL = r"""
WITH t AS (SELECT list_transform(range(256), lambda c: list_reduce([c, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t),
d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
             xor(list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
                             lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS h FROM documents, t),
g AS (SELECT *, len(ws) AS n, (h // 10) % greatest(len(ws), 1) AS a, 1 + (len(ws) - (h // 10) % greatest(len(ws), 1)) // (3 + (h // 10) % 8) AS p FROM d),
m AS (SELECT k, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
             THEN list_transform(range(n), lambda i: ws[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) ELSE ws END AS ws FROM g),
w AS (SELECT k, n, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS i FROM m),
x AS (SELECT k, n, i, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o) AS five
      FROM w WINDOW o AS (PARTITION BY k ORDER BY i) QUALIFY lead(word, 4) OVER o IS NOT NULL),
e AS (SELECT a.k, b.i - a.i AS q, a.i FROM x a JOIN x b ON a.k = b.k AND a.five = b.five AND b.i > a.i AND b.i - a.i <= a.n // 4),
s AS (SELECT k, q, min(i) AS start, count(*) + 4 + q AS length
      FROM (SELECT *, i - row_number() OVER (PARTITION BY k, q ORDER BY i) AS stretch FROM e)
      GROUP BY k, q, stretch HAVING count(*) + 4 + q >= greatest(6, 4 * q)),
r AS (SELECT k, start, length, min(q) AS period FROM s GROUP BY ALL),
b AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY k ORDER BY length / period DESC, start, period) = 1),
l AS (SELECT k, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs FROM r GROUP BY k),
z AS (SELECT DISTINCT k, unnest(range(start + period, start + length)) AS i FROM r),
c AS (SELECT k, string_agg(word, ' ' ORDER BY i) AS collapsed FROM w ANTI JOIN z USING (k, i) GROUP BY k)
SELECT m.doc_id, coalesce(n_runs, 0) AS n_runs, b.start, b.length, b.period, (1000 * b.length) // b.period AS exponent_milli,
       sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM m LEFT JOIN l ON l.k = m.k LEFT JOIN b ON b.k = m.k LEFT JOIN c ON c.k = m.k
"""
