"""Entity resolution: scored record pairs of two sources and their evaluation."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from quern.operators.joins import CELL_ROWS, grid_join_sized, lookup_join
from quern.operators.text import term_frequency, unit_weights
from quern.session import stable


def pair_weights(
    a: DataFrame, b: DataFrame, id_a: str, id_b: str, tokens_a: Column, tokens_b: Column, shared: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Unit TF-IDF vectors of two sources with IDF over both: ``id, token, weight`` each.

    Rows also carry the record count of their token (``_n``) and its join grid
    (``_across``, ``_down``), which fall out of the same aggregation as its IDF; a grid of
    0 marks a token only one source has. Texts are split once; the frequencies and the token
    table are written, as in ``operators.text.tfidf``. With ``shared`` only tokens of both
    sources are left, all that scores need; the others count in the norms.
    """
    tf_a, tf_b = (stable(term_frequency(df, i, t)) for df, i, t in ((a, id_a, tokens_a), (b, id_b, tokens_b)))
    has = tf_a.select("token", F.lit(1).alias("_a")).unionAll(tf_b.select("token", F.lit(0).alias("_a")))
    n = a.agg(F.count_distinct(id_a)).scalar() + b.agg(F.count_distinct(id_b)).scalar()
    counts = has.groupBy("token").agg(F.count("*").alias("_n"), F.sum("_a").alias("_n_a"))
    n_a, n_b = F.col("_n_a"), F.col("_n") - F.col("_n_a")
    tokens = stable(
        counts.select(
            "token",
            "_n",
            (n / F.col("_n")).alias("idf"),
            F.when(n_b > 0, F.ceil(n_a / CELL_ROWS)).otherwise(0).cast("int").alias("_across"),
            F.when(n_a > 0, F.ceil(n_b / CELL_ROWS)).otherwise(0).cast("int").alias("_down"),
        )
    )

    def weighted(tf: DataFrame) -> DataFrame:
        joined = lookup_join(tf, tokens, "token").withColumn("weight", F.col("tf") * F.col("idf")).drop("tf", "idf")
        return unit_weights(joined)

    if not shared:
        return weighted(tf_a), weighted(tf_b)
    both = F.when((F.col("_across") > 0) & (F.col("_down") > 0), F.monotonically_increasing_id())
    tokens = stable(tokens.withColumn("_code", both))
    names = stable(tokens.filter("_code IS NOT NULL").drop("idf"))

    def named(tf: DataFrame) -> DataFrame:
        """The norms take numbers of tokens, null for those of one source; names are looked up for the rest."""
        joined = lookup_join(tf, tokens.select("token", "idf", "_code"), "token")
        unit = unit_weights(joined.select("id", "_code", (F.col("tf") * F.col("idf")).alias("weight")))
        found = lookup_join(unit.filter("_code IS NOT NULL"), names, "_code")
        return found.select("id", "token", "weight", "_n", "_across", "_down")

    return named(tf_a), named(tf_b)


def _shared(df: DataFrame, id_name: str, weight: str) -> DataFrame:
    rows = df.filter("_across > 0 and _down > 0")
    return rows.select(F.col("id").alias(id_name), "token", F.col("weight").alias(weight), "_n", "_across", "_down")


def cosine_pairs_blocked(weights_a: DataFrame, weights_b: DataFrame, min_score: float | None = None) -> DataFrame:
    """Cosine of every pair that shares a token: ``id_a, id_b, score``.

    Takes the two tables of ``pair_weights``, stored. The result has as many rows as pairs
    share a token; they come straight from blocks of records (``weight_bins``), and none is
    shuffled. With ``min_score`` only pairs that reach it are returned, exactly, and pairs
    are formed from rare tokens alone: with tokens ranked from rare to frequent, a token
    from which on the rest of a vector is shorter than ``min_score`` cannot be the first
    shared token of such a pair.
    """
    if min_score is None:
        met = _block_pairs(weights_a, weights_b)[0]
        kinds = [f"id_{s} {w.schema['id'].dataType.simpleString()}" for s, w in (("a", weights_a), ("b", weights_b))]
        return met.select(*_SIDES).mapInArrow(_listed, ", ".join([*kinds, "score double"]))

    a, b = _shared(weights_a, "id_a", "w_a"), _shared(weights_b, "id_b", "w_b")
    slack = min_score * (1 - 1e-9)

    def prefix(df: DataFrame, id_name: str, weight: str) -> DataFrame:
        rest = W.partitionBy(id_name).orderBy(F.desc("_n"), F.desc("token")).rowsBetween(W.unboundedPreceding, 0)
        length = F.sqrt(F.sum(F.col(weight) * F.col(weight)).over(rest))
        return df.withColumn("_rest", length).filter(F.col("_rest") >= slack).drop("_rest", "_n", weight)

    met = grid_join_sized(prefix(a, "id_a", "w_a"), prefix(b, "id_b", "w_b"), ["token"], "id_a", "id_b")
    candidates = stable(met.select("id_a", "id_b").distinct())
    return score_pairs(weights_a, weights_b, candidates).filter(F.col("score") >= min_score)


def score_pairs(weights_a: DataFrame, weights_b: DataFrame, pairs: DataFrame) -> DataFrame:
    """Sum of weight products of given pairs ``id_a, id_b``; pairs without a shared token are left out.

    A record in many pairs has its vector copied to as many cells as its pairs need; a
    record in none is dropped before any join. ``pairs`` and the weights are read several
    times: pass stored tables.
    """

    def cells(own: str) -> DataFrame:
        return stable(pairs.groupBy(own).agg(F.ceil(F.count("*") / CELL_ROWS).cast("int").alias("_cells")))

    sizes = {own: cells(own) for own in ("id_a", "id_b")}

    def place(rows: DataFrame, own: str, other: str) -> DataFrame:
        cell = F.pmod(F.xxhash64(other), F.col("_cells")).cast("int")
        return lookup_join(rows, sizes[own], own).withColumn(f"_cell_{own}", cell).drop("_cells")

    def copied(weights: DataFrame, own: str, weight: str) -> DataFrame:
        each = F.explode(F.sequence(F.lit(0), F.col("_cells") - 1)).alias(f"_cell_{own}")
        named = weights.select(F.col("id").alias(own), "token", F.col("weight").alias(weight))
        return named.join(sizes[own], own).select(own, "token", weight, each)

    placed = place(place(pairs.select("id_a", "id_b"), "id_a", "id_b"), "id_b", "id_a")
    half = placed.join(copied(weights_a, "id_a", "w_a"), ["id_a", "_cell_id_a"])
    both = half.join(copied(weights_b, "id_b", "w_b"), ["id_b", "token", "_cell_id_b"])
    return both.groupBy("id_a", "id_b").agg(F.sum(F.col("w_a") * F.col("w_b")).alias("score"))


def token_block_join(index_a: DataFrame, index_b: DataFrame) -> DataFrame:
    """Shared tokens of every pair with one: ``id_a, id_b, tokens`` (sorted).

    Takes two inverted indexes ``token, id`` without repeats. Pairs come from blocks of
    records, whole, so that none is shuffled; a pair's list is bounded by its records.
    """
    sides = [stable(index.select("id", "token", F.lit(1.0).alias("weight"))) for index in (index_a, index_b)]
    met = _block_pairs(*sides, named=True)[0]
    kinds = [f"id_{s} {w.schema['id'].dataType.simpleString()}" for s, w in zip("ab", sides)]
    found = met.select(*_SIDES, "a_token").mapInArrow(_sharing, ", ".join([*kinds, "tokens array<string>"]))
    return found.select("id_a", "id_b", F.sort_array("tokens").alias("tokens"))


INDEX_BUCKETS = 64


def write_index(weights: DataFrame, path: str, buckets: int = INDEX_BUCKETS) -> None:
    """Writes vectors clustered by record: a folder for each bucket of ids, sorted by id inside."""
    placed = weights.withColumn("bucket", _bucket(F.col("id"), buckets)).repartition(buckets, "bucket")
    placed.sortWithinPartitions("bucket", "id").write.partitionBy("bucket").parquet(path)


def _bucket(record: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(record), F.lit(buckets)).cast("int")


def read_index(spark: SparkSession, path: str, ids: Sequence | None = None, buckets: int = INDEX_BUCKETS) -> DataFrame:
    """Vectors of a written index: all, or those of the listed records.

    For those only the folders of their buckets are read, and of them the parts that may
    hold the ids.
    """
    rows = spark.read.parquet(path)
    if ids is None:
        return rows.drop("bucket")
    own = [F.lit(i).cast(rows.schema["id"].dataType) for i in ids]
    return rows.filter(F.col("bucket").isin(*[_bucket(i, buckets) for i in own]) & F.col("id").isin(*own)).drop("bucket")


def lookup_scores(vectors_a: DataFrame, vectors_b: DataFrame, pairs: Sequence[tuple]) -> DataFrame:
    """Scores ``id_a, id_b, score`` of a few pairs from vectors read for them; pairs without a shared token are left out."""
    kinds = [f"id_{s} {v.schema['id'].dataType.simpleString()}" for s, v in (("a", vectors_a), ("b", vectors_b))]
    asked = vectors_a.sparkSession.createDataFrame(list(dict.fromkeys(map(tuple, pairs))), ", ".join(kinds))
    a, b = (v.select(F.col("id").alias(f"id_{s}"), "token", F.col("weight").alias(f"w_{s}")) for s, v in (("a", vectors_a), ("b", vectors_b)))
    met = asked.join(a, "id_a").join(b, ["id_b", "token"])
    return met.groupBy("id_a", "id_b").agg(F.sum(F.col("w_a") * F.col("w_b")).alias("score"))


def gold_evaluation(sims: DataFrame, gold: DataFrame, all_pairs: Column | None = None) -> DataFrame:
    """Count and mean score of true pairs, mean score of the others.

    ``sims`` holds pairs with a score above 0. ``all_pairs`` is the number of pairs of the
    two sources: pairs missing from ``sims`` then count with score 0, as if every pair
    had been scored.
    """
    return evaluated(scored_bins(sims, gold, 1), _size_of(gold), all_pairs)


def _wanted(gold: DataFrame) -> DataFrame:
    return gold.select("id_a", "id_b").distinct()


def _size_of(gold: DataFrame) -> Column:
    return _wanted(gold).agg(F.count("*")).scalar()


def scored_bins(sims: DataFrame, gold: DataFrame, n: int) -> DataFrame:
    """Score counts of a table of pairs: ``bin, pairs, true_cut, true, total, true_total``, without empty bins.

    Bin k is k/n up to (k+1)/n. ``pairs`` and ``true_cut`` (those of ``gold``) go by the
    truncated score, ``true`` by the exact one: the last threshold k/n that the score
    reaches, which truncating ``score * n`` can miss by one. The totals are sums of scores.
    """
    x = F.col("score")
    cut = F.least(F.floor(x * n), F.lit(n))
    exact = F.when(x < cut / F.lit(n), cut - 1).when(x >= (cut + 1) / F.lit(n), cut + 1).otherwise(cut)
    marked = sims.join(_wanted(gold).withColumn("_gold", F.lit(1)), ["id_a", "id_b"], "left")
    true = F.col("_gold").isNotNull()
    counted = marked.groupBy(cut.alias("_cut"), exact.alias("_exact")).agg(
        F.count("*").alias("_n"), F.count("_gold").alias("_g"), F.sum(x).alias("_s"), F.sum(F.when(true, x).otherwise(0.0)).alias("_t")
    )
    zero, nothing = F.lit(0).cast("bigint"), F.lit(0.0)
    entries = [
        F.struct(F.col("_cut").alias("bin"), F.col("_n").alias("pairs"), F.col("_g").alias("true_cut"), zero.alias("true"),
                 F.col("_s").alias("total"), F.col("_t").alias("true_total")),
        F.struct(F.col("_exact").alias("bin"), zero.alias("pairs"), zero.alias("true_cut"), F.col("_g").alias("true"),
                 nothing.alias("total"), nothing.alias("true_total")),
    ]
    return _added(counted.select(F.explode(F.array(*entries)).alias("e")).select("e.*"))


_BIN_COLUMNS = ("pairs", "true_cut", "true", "total", "true_total")
BINS = "bin bigint, pairs bigint, true_cut bigint, true bigint, total double, true_total double"


def _added(bins: DataFrame) -> DataFrame:
    return bins.groupBy("bin").agg(*[F.sum(c).alias(c) for c in _BIN_COLUMNS])


BLOCK_RECORDS = 1024
_PRODUCTS_AT_ONCE, _PAIRS_AT_ONCE = 1 << 22, 1 << 18


def _block_pairs(a: DataFrame, b: DataFrame, named: bool = False) -> tuple[DataFrame, Column, Column]:
    """Every block of the records of ``a`` next to every block of ``b``: lists ``a_id, a_code, a_weight`` and so on.

    Takes stored tables ``id, token, weight``. Records are dealt to blocks by a hash of their
    id, and only tokens that both sides have stay, with numbers; ``named`` lists the tokens
    too, as ``a_token``. The two columns returned are the block of a pair ``id_a, id_b``.

    The side of fewer blocks is copied to every block of the other. The copies are shuffled:
    Spark takes their size for that of one, so without the hint it would broadcast them all.
    """
    tokens = stable(
        a.select("token").distinct().join(b.select("token").distinct(), "token", "left_semi")
        .withColumn("code", F.monotonically_increasing_id())
    )

    def blocks(weights: DataFrame, side: str) -> tuple[DataFrame, int]:
        kept = ["id", "code", "weight", *["token"] * (named and side == "a")]
        count = max(1, -(-weights.agg(F.count_distinct("id")).first()[0] // BLOCK_RECORDS))
        coded = lookup_join(weights.select("id", "token", "weight"), tokens, "token")
        block = F.pmod(F.xxhash64("id"), F.lit(count)).cast("int").alias(f"block_{side}")
        rows = coded.select(block, F.struct(*kept).alias("r")).groupBy(f"block_{side}").agg(F.collect_list("r").alias("r"))
        return rows.select(f"block_{side}", *[F.col(f"r.{c}").alias(f"{side}_{c}") for c in kept]), count

    (left, n_a), (right, n_b) = blocks(a, "a"), blocks(b, "b")
    few, many, place, n = (left, right, "block_b", n_b) if n_a <= n_b else (right, left, "block_a", n_a)
    copies = stable(few).withColumn(place, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    met = copies.hint("merge").join(many, place)
    places = [F.pmod(F.xxhash64(f"id_{s}"), F.lit(n)).cast("int").alias(f"block_{s}") for s, n in (("a", n_a), ("b", n_b))]
    return met, *places


_SIDES = [f"{s}_{c}" for s in "ab" for c in ("id", "code", "weight")]


def weight_bins(weights_a: DataFrame, weights_b: DataFrame, gold: DataFrame, n: int, digits: int | None = None) -> DataFrame:
    """``scored_bins`` of every pair that shares a token, straight from the vectors ``id, token, weight``.

    Records are packed into blocks, with their tokens as numbers; a task takes two blocks,
    adds the products of the postings of one with the other to a table of scores, and hands
    on counts per bin, so that no pair is ever a row. True pairs travel with the two blocks
    they lie in. ``digits`` rounds scores. Weights are positive; pass stored tables.
    """
    met, *places = _block_pairs(weights_a, weights_b)
    true = _wanted(gold).groupBy(*places).agg(F.collect_list(F.struct("id_a", "id_b")).alias("g"))
    true = true.select("block_a", "block_b", F.col("g.id_a").alias("gold_a"), F.col("g.id_b").alias("gold_b"))
    pairs = met.join(stable(true), ["block_a", "block_b"], "left").select(*_SIDES, "gold_a", "gold_b")
    return _added(pairs.mapInArrow(_histograms(n, digits), BINS))


def _blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, _Block, _Block]]:
    for batch in batches:
        for i in range(batch.num_rows):
            a, b = (_Block(*[batch.column(c)[i].values for c in cs]) for cs in ((0, 1, 2), (3, 4, 5)))
            yield batch, i, a, b


def _histograms(n: int, digits: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((3, n + 2), np.int64), np.zeros((2, n + 2))
        for batch, i, a, b in _blocks_of(batches):
            scores = _scores(a, b)
            hit = np.flatnonzero(scores)
            score = scores[hit] if digits is None else np.round(scores[hit], digits)
            cut = np.minimum(np.floor(score * n), n).astype(np.int64)
            exact = cut - (score < cut / n) + (score >= (cut + 1) / n)
            true = np.isin(hit, _places(a, b, batch.column(6)[i].values, batch.column(7)[i].values))
            for at, bins in enumerate((cut, cut[true], exact[true])):
                counts[at] += np.bincount(bins, minlength=n + 2)
            for at, (bins, x) in enumerate(((cut, score), (cut[true], score[true]))):
                sums[at] += np.bincount(bins, weights=x, minlength=n + 2)
        some = np.flatnonzero(counts.any(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[some]) for x in (np.arange(n + 2), *counts, *sums)], ["bin", *_BIN_COLUMNS]
        )

    return run


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every pair of two blocks with a score, a slice of pairs at a time."""
    for _, _, a, b in _blocks_of(batches):
        scores = _scores(a, b)
        hit = np.flatnonzero(scores)
        for at in range(0, len(hit), _PAIRS_AT_ONCE):
            part = hit[at : at + _PAIRS_AT_ONCE]
            i, j = part // len(b.ids), part % len(b.ids)
            yield pa.RecordBatch.from_arrays(
                [a.ids.take(pa.array(i)), b.ids.take(pa.array(j)), pa.array(scores[part])], ["id_a", "id_b", "score"]
            )


def _sharing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tokens that each pair of two blocks shares; records of ``a`` a few at a time."""
    for batch, i, a, b in _blocks_of(batches):
        names = dict(zip(batch.column(1)[i].values.to_pylist(), batch.column(6)[i].values.to_pylist()))
        for of, at in _met(a, b):
            pair = a.record[of] * len(b.ids) + b.record[at]
            order = np.argsort(pair, kind="stable")
            pair, code = pair[order], a.code[of][order]
            first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(pair) else np.empty(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(pair)), pa.int32()), pa.array([names[c] for c in code.tolist()], pa.string()))
            ids = [side.ids.take(pa.array(x)) for side, x in ((a, pair[first] // len(b.ids)), (b, pair[first] % len(b.ids)))]
            yield pa.RecordBatch.from_arrays([*ids, lists], ["id_a", "id_b", "tokens"])


class _Block:
    """Records of a block by place; their tokens sorted, so that those of one token stand together."""

    def __init__(self, ids: pa.Array, codes: pa.Array, weights: pa.Array):
        named = ids.dictionary_encode(null_encoding="encode")
        self.ids = named.dictionary
        code = codes.to_numpy(zero_copy_only=False)
        order = np.argsort(code, kind="stable")
        self.code = code[order]
        self.record = named.indices.to_numpy(zero_copy_only=False).astype(np.int64)[order]
        self.weight = weights.to_numpy(zero_copy_only=False)[order]


def _met(a: _Block, b: _Block, whole_records: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Where entries of ``a`` and of ``b`` have one token, some millions at a time; a record of ``a`` comes as a whole or by token."""
    rows = np.argsort(a.record, kind="stable") if whole_records else np.arange(len(a.code))
    first = np.searchsorted(b.code, a.code[rows], "left")
    count = np.searchsorted(b.code, a.code[rows], "right") - first
    upto = np.cumsum(count)
    stops = np.flatnonzero(np.append(np.diff(a.record[rows]) != 0, True)) + 1 if whole_records else np.arange(1, len(rows) + 1)
    begin = 0
    while begin < len(rows):
        done = upto[begin - 1] if begin else 0
        fits = int(np.searchsorted(upto, done + _PRODUCTS_AT_ONCE, "right"))
        at = int(np.searchsorted(stops, max(fits, begin + 1), "right"))
        end = int(stops[max(at - 1, 0)]) if at and stops[at - 1] > begin else int(stops[np.searchsorted(stops, begin, "right")])
        size = count[begin:end]
        of = np.repeat(np.arange(begin, end), size)
        yield rows[of], np.arange(len(of)) + np.repeat(first[begin:end] - (np.cumsum(size) - size), size)
        begin = end


def _scores(a: _Block, b: _Block) -> np.ndarray:
    """Sums of weight products of all pairs of two blocks, the pairs of a record of ``a`` in a row."""
    width = len(b.ids)
    total = np.zeros(len(a.ids) * width)
    for of, at in _met(a, b, whole_records=False):
        total += np.bincount(a.record[of] * width + b.record[at], weights=a.weight[of] * b.weight[at], minlength=len(total))
    return total


def _places(a: _Block, b: _Block, gold_a: pa.Array | None, gold_b: pa.Array | None) -> np.ndarray:
    """Where the true pairs stand among the scores of two blocks."""
    if gold_a is None:
        return np.empty(0, np.int64)
    i, j = (pc.index_in(g, value_set=side.ids) for g, side in ((gold_a, a), (gold_b, b)))
    both = pc.and_(i.is_valid(), j.is_valid())
    i, j = (x.filter(both).to_numpy(zero_copy_only=False).astype(np.int64) for x in (i, j))
    return i * len(b.ids) + j


def evaluated(bins: DataFrame, n_gold: Column | int, all_pairs: Column | int | None = None) -> DataFrame:
    """One row ``true_pairs, mean_true, mean_other`` from score counts, as ``gold_evaluation`` gives."""
    sums = bins.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _BIN_COLUMNS])
    true_n = F.col("true_cut") if all_pairs is None else F.lit(n_gold)
    other_n = F.col("pairs") - F.col("true_cut") if all_pairs is None else F.lit(all_pairs) - n_gold
    return sums.select(
        true_n.alias("true_pairs"),
        F.try_divide(F.col("true_total"), true_n).alias("mean_true"),
        F.try_divide(F.col("total") - F.col("true_total"), other_n).alias("mean_other"),
    )


def _filled(bins: DataFrame, n_gold: Column | int, n: int) -> DataFrame:
    """All bins 0..n; true pairs that were never scored count in bin 0."""
    every = bins.sparkSession.range(n + 1).select(F.col("id").alias("bin"))
    filled = every.join(bins, "bin", "left").na.fill(0)
    missing = F.when(F.col("bin") == 0, n_gold - F.sum("true").over(W.partitionBy())).otherwise(0)  # n + 1 rows
    return filled.withColumn("_missing", missing).select(
        "bin",
        "pairs",
        (F.col("true_cut") + F.col("_missing")).alias("true_cut"),
        (F.col("true") + F.col("_missing")).alias("true"),
    )


def other_counts(bins: DataFrame, n_gold: Column | int, n: int = 100) -> DataFrame:
    """Pairs per truncated score bin 0..n with the bins of true pairs taken off."""
    return _filled(bins, n_gold, n).select("bin", (F.col("pairs") - F.col("true_cut")).alias("n"))


def bin_counts(sims: DataFrame, gold: DataFrame, n: int = 100) -> DataFrame:
    """``other_counts`` of a table of scored pairs."""
    return other_counts(scored_bins(sims, gold, n), _size_of(gold), n)


def threshold_sweep(sims: DataFrame, gold: DataFrame, n: int = 100) -> DataFrame:
    """``swept`` of a table of scored pairs."""
    return swept(scored_bins(sims, gold, n), _size_of(gold), n)


def swept(bins: DataFrame, n_gold: Column | int, n: int = 100) -> DataFrame:
    """Precision, recall and F for thresholds 0, 1/n, .. (n-1)/n from score counts.

    The sweep is a running sum over n + 1 bins. False positives come from truncated bins;
    false negatives compare scores to the threshold itself, with true pairs that were never
    scored at 0.
    """
    upward = W.orderBy(F.desc("bin")).rowsBetween(W.unboundedPreceding, 0)  # n + 1 rows
    counted = _filled(bins, n_gold, n).select(
        "bin",
        F.sum(F.col("pairs") - F.col("true_cut")).over(upward).alias("fp"),
        F.sum("true").over(upward).alias("tp"),
        F.sum("true").over(W.partitionBy()).alias("_all"),
    ).filter(F.col("bin") < n)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    rates = counted.withColumn("fn", F.col("_all") - tp).withColumns(
        {"precision": F.try_divide(tp, tp + fp), "recall": F.try_divide(tp, tp + fn)}
    )
    f = F.try_divide(2 * F.col("recall") * F.col("precision"), F.col("recall") + F.col("precision"))
    return rates.select((F.col("bin") / n).alias("threshold"), "tp", "fp", "fn", "precision", "recall", f.alias("f"))
