"""TF-IDF weights and entity resolution against plain Python."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from quern.functions.text import simple_tokenize
from quern.operators import matching as E, text as X
from quern.session import scratch_path, stable

def tokens():
    return simple_tokenize(F.col("text"))


def docs(spark, texts):
    return spark.createDataFrame(list(texts.items()), "id string, text string")


def test_term_frequency(spark):
    rows = X.term_frequency(docs(spark, {"a": "one_ one_ two!", "b": ""}), "id", tokens()).collect()
    assert {r.token: r.tf for r in rows} == {"one_": pytest.approx(2 / 3), "two": pytest.approx(1 / 3)}


def test_idf_counts_records_and_distinct_ids(spark):
    rows = spark.createDataFrame([("a", "x y x"), ("a", "x"), ("b", "z")], "id string, text string")
    assert {r.token: r.idf for r in X.idf(rows, "id", tokens()).collect()} == {"x": 1.0, "y": 2.0, "z": 2.0}


def test_norm_and_dot(spark):
    weights = spark.createDataFrame([("a", "foo", 2.0), ("a", "bar", 3.0), ("a", "baz", 5.0)], "id string, token string, weight double")
    other = spark.createDataFrame([("b", "foo", 1.0), ("b", "bar", 0.0), ("b", "baz", 20.0)], "id string, token string, weight double")
    assert X.doc_norms(weights).first().norm == pytest.approx(6.16441400297)
    pair = spark.createDataFrame([("a", "b")], "id_a string, id_b string")
    assert E.score_pairs(weights, other, pair).first().score == 102.0


def test_tasks_get_a_bounded_piece_of_the_texts(spark, monkeypatch):
    texts = docs(spark, {f"d{i}": "some words " * 20 for i in range(50)})
    expected = {tuple(r) for r in X.term_frequency(texts, "id", tokens()).collect()}
    monkeypatch.setattr(X, "TASK_BYTES", 500)
    found = X.term_frequency(texts, "id", tokens())
    assert found.rdd.getNumPartitions() >= 50 * 220 // 500
    assert {tuple(r) for r in found.collect()} == expected


def test_inverted_index(spark):
    weights = spark.createDataFrame([(1, "foo", 2.0)], "id int, token string, weight double")
    assert [tuple(r) for r in X.inverted_index(weights).collect()] == [("foo", 1)]


def naive(a, b):
    """Cosine of every pair of two sources, the slow way."""
    vectors, seen = {}, {}
    for side, texts in (("a", a), ("b", b)):
        for i, text in texts.items():
            words = text.split()
            vectors[side, i] = {w: words.count(w) / len(words) for w in words}
            for w in set(words):
                seen[w] = seen.get(w, 0) + 1
    n = len(a) + len(b)
    for v in vectors.values():
        for w in v:
            v[w] *= n / seen[w]

    def norm(v):
        return math.sqrt(sum(x * x for x in v.values()))

    return {
        (i, j): sum(vectors["a", i][w] * vectors["b", j].get(w, 0) for w in vectors["a", i])
        / norm(vectors["a", i]) / norm(vectors["b", j])
        for i, j in itertools.product(a, b)
    }


@pytest.fixture(scope="module")
def sources():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(25)]

    def text():
        frequent = ["the"] * rng.choice([0, 1, 2])
        return " ".join(frequent + [rng.choice(words) for _ in range(rng.randint(2, 9))])

    return {f"a{i}": text() for i in range(12)}, {f"b{i}": text() for i in range(30)}


@pytest.fixture(scope="module", params=[3, 20_000])
def weights(request, spark, sources):
    cell_rows, E.CELL_ROWS = E.CELL_ROWS, request.param
    a, b = sources
    yield tuple(map(stable, E.pair_weights(docs(spark, a), docs(spark, b), "id", "id", tokens(), tokens())))
    E.CELL_ROWS = cell_rows


def scores(df):
    rows = [tuple(r) for r in df.select("id_a", "id_b", "score").collect()]
    assert len({r[:2] for r in rows}) == len(rows)
    return {r[:2]: r[2] for r in rows}


def test_blocked_pairs_equal_all_pairs(weights, sources):
    expected = {k: v for k, v in naive(*sources).items() if v > 0}
    assert scores(E.cosine_pairs_blocked(*weights)) == pytest.approx(expected, rel=1e-9)


def test_vectors_of_shared_tokens_score_alike(spark, sources):
    a, b = sources
    b = {**b, "b_own": "w1 nowhere else"}
    frames = docs(spark, a), docs(spark, b)
    sides = tuple(map(stable, E.pair_weights(*frames, "id", "id", tokens(), tokens(), shared=True)))
    assert sides[1].filter("token in ('nowhere', 'else')").count() == 0
    every = E.pair_weights(*frames, "id", "id", tokens(), tokens())
    for side, whole in zip(sides, every):
        assert sorted(map(tuple, side.select("id", "token", "_n", "_across", "_down").collect())) == sorted(
            map(tuple, whole.filter("_across > 0 and _down > 0").select("id", "token", "_n", "_across", "_down").collect())
        )
    expected = {k: v for k, v in naive(a, b).items() if v > 0}
    assert scores(E.cosine_pairs_blocked(*sides)) == pytest.approx(expected, rel=1e-9)
    least = {k: v for k, v in expected.items() if v >= 0.3}
    assert scores(E.cosine_pairs_blocked(*sides, min_score=0.3)) == pytest.approx(least, rel=1e-9)


def test_blocks_for_scores_have_no_token_texts(weights):
    assert "a_token" not in E._block_pairs(*weights)[0].columns


def test_contained_items_by_hashes_of_words(spark):
    from quern.plans.data import contained_items

    items = {1: "a b c d e f g", 2: "b c", 3: "x", 4: "c d e", 5: "never here at all", 6: None}
    texts = {10: "z a b c d e f gg", 11: "b c d e", 12: "x", 13: None, 14: "", 15: "a b c d"}
    found = contained_items(
        spark.createDataFrame(list(texts.items()), "doc_id int, text string"),
        spark.createDataFrame(list(items.items()), "item_id int, text string"),
    )
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in found.collect()} == {(1, 10), (2, 10), (2, 11), (3, 12), (4, 10), (4, 11), (2, 15)}
    assert "slice(" not in plan  # the candidates were written


@pytest.mark.parametrize("least", [0.05, 0.3, 0.7, 0.99])
def test_least_score_loses_no_pair(weights, sources, least):
    expected = {k: v for k, v in naive(*sources).items() if v >= least}
    assert scores(E.cosine_pairs_blocked(*weights, min_score=least)) == pytest.approx(expected, rel=1e-9)


def test_identical_records_reach_one(spark):
    texts = {"x": "alpha beta", "y": "gamma"}
    a, b = map(stable, E.pair_weights(docs(spark, texts), docs(spark, texts), "id", "id", tokens(), tokens()))
    found = scores(E.cosine_pairs_blocked(a, b, min_score=1 - 1e-9))
    assert set(found) == {("x", "x"), ("y", "y")}


def test_shared_tokens(spark, sources):
    a, b = sources
    index = [X.record_tokens(docs(spark, a), tokens())]  # reading tokens alone keeps every record
    assert index[0].count() == sum(len(set(t.split())) for t in a.values())
    rows = E.token_block_join(
        docs(spark, a).select(F.explode(F.array_distinct(tokens())).alias("token"), "id"),
        docs(spark, b).select(F.explode(F.array_distinct(tokens())).alias("token"), "id"),
    ).collect()
    expected = {
        (i, j): sorted(set(x.split()) & set(y.split()))
        for (i, x), (j, y) in itertools.product(a.items(), b.items())
        if set(x.split()) & set(y.split())
    }
    assert {(r.id_a, r.id_b): r.tokens for r in rows} == expected


@pytest.fixture(scope="module")
def judged(spark, sources):
    """Scored pairs and a mapping that also has pairs without a shared token."""
    every = naive(*sources)
    ranked = sorted(every, key=lambda p: (-every[p], p))
    gold = ranked[:6] + [p for p in ranked if every[p] == 0][:2] + ranked[40:43]
    sims = {k: v for k, v in every.items() if v > 0}
    sims[ranked[1]] = 0.29  # 0.29 * 100 truncates to 28
    frame = spark.createDataFrame([(*k, v) for k, v in sims.items()], "id_a string, id_b string, score double")
    return sims, gold, frame, spark.createDataFrame(gold, "id_a string, id_b string")


def test_gold_evaluation(judged, sources, spark):
    sims, gold, frame, gold_frame = judged
    pairs = len(sources[0]) * len(sources[1])
    got = E.gold_evaluation(frame, gold_frame, F.lit(pairs)).first()
    assert got.true_pairs == len(gold)
    assert got.mean_true == pytest.approx(sum(sims.get(p, 0) for p in gold) / len(gold))
    others = sum(v for p, v in sims.items() if p not in gold)
    assert got.mean_other == pytest.approx(others / (pairs - len(gold)))


@pytest.mark.parametrize("block, n, digits", [(3, 100, None), (1024, 7, 3)])
def test_bins_of_weights_are_those_of_pairs(spark, weights, sources, monkeypatch, block, n, digits):
    monkeypatch.setattr(E, "BLOCK_RECORDS", block)
    every = naive(*sources)
    ranked = sorted(every, key=lambda p: (-every[p], p))
    gold = ranked[:6] + ranked[30:33] + [p for p in ranked if every[p] == 0][:2] + [("no such", "record")]
    gold_frame = spark.createDataFrame(gold + gold[:1], "id_a string, id_b string")
    sims = E.cosine_pairs_blocked(*weights)
    if digits is not None:
        sims = sims.withColumn("score", F.round("score", digits))
    expected = {r.bin: r for r in E.scored_bins(sims, gold_frame, n).collect()}
    got = {r.bin: r for r in E.weight_bins(*weights, gold_frame, n, digits).collect()}
    assert set(got) == set(expected)
    for k, r in got.items():
        assert (r.pairs, r.true_cut, r.true) == (expected[k].pairs, expected[k].true_cut, expected[k].true)
        assert (r.total, r.true_total) == pytest.approx((expected[k].total, expected[k].true_total))


def test_bins_of_no_weights(spark, weights):
    a, b = weights
    gold = spark.createDataFrame([("x", "y")], "id_a string, id_b string")
    bins = E.weight_bins(a.limit(0), b, gold, 10)
    assert bins.count() == 0
    assert [r.tp for r in E.swept(bins, 1, 2).orderBy("threshold").collect()] == [1, 0]


def test_threshold_sweep(judged):
    sims, gold, frame, gold_frame = judged
    n = 100
    true_scores = [sims.get(p, 0.0) for p in gold]
    bins = [0] * (n + 1)
    for s in sims.values():
        bins[int(s * n)] += 1
    for s in true_scores:
        bins[int(s * n)] -= 1
    assert [r.n for r in E.bin_counts(frame, gold_frame, n).orderBy("bin").collect()] == bins
    rows = E.threshold_sweep(frame, gold_frame, n).orderBy("threshold").collect()
    assert len(rows) == n
    for i, row in enumerate(rows):
        fp = sum(bins[i:])
        fn = sum(1 for s in true_scores if s < i / n)
        tp = len(gold) - fn
        assert (row.threshold, row.tp, row.fp, row.fn) == (i / n, tp, fp, fn)
        assert row.recall == pytest.approx(tp / len(gold))
        assert row.precision == (pytest.approx(tp / (tp + fp)) if tp + fp else None)


def test_pairs_and_tokens_by_small_blocks(spark, weights, sources, monkeypatch):
    expected = {k: v for k, v in naive(*sources).items() if v > 0}
    for block, products in ((2, 5), (7, 1 << 22)):
        monkeypatch.setattr(E, "BLOCK_RECORDS", block)
        monkeypatch.setattr(E, "_PRODUCTS_AT_ONCE", products)
        monkeypatch.setattr(E, "_PAIRS_AT_ONCE", products)
        assert scores(E.cosine_pairs_blocked(*weights)) == pytest.approx(expected, rel=1e-9)
        index = [docs(spark, side).select(F.explode(F.array_distinct(tokens())).alias("token"), "id") for side in sources]
        shared = {(r.id_a, r.id_b): r.tokens for r in E.token_block_join(*index).collect()}
        assert shared == {
            (i, j): sorted(set(sources[0][i].split()) & set(sources[1][j].split())) for i, j in expected
        }


def test_pairs_are_not_shuffled(weights):
    plan = E.cosine_pairs_blocked(*weights)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan.split("Exchange")[0]


@pytest.mark.parametrize("swapped", [False, True])
def test_copies_of_blocks_are_not_broadcast(weights, sources, monkeypatch, swapped):
    monkeypatch.setattr(E, "BLOCK_RECORDS", 2)
    sides = weights[::-1] if swapped else weights
    found = E.cosine_pairs_blocked(*sides)
    got = scores(found.select("*"))
    assert {pair[::-1] if swapped else pair: s for pair, s in got.items()} == pytest.approx(
        {k: v for k, v in naive(*sources).items() if v > 0}, rel=1e-9
    )
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "Generate explode" in plan
    assert "Broadcast" not in plan.split("Initial Plan")[0].split("Generate explode")[0]


def test_index_reads_the_wanted_buckets_only(spark, weights, sources):
    paths = [scratch_path(spark, "index") for _ in weights]
    for side, path in zip(weights, paths):
        E.write_index(side, path, 8)
    assert E.read_index(spark, paths[0]).count() == weights[0].count()
    every = naive(*sources)
    pairs = sorted(every, key=lambda p: -every[p])[:2] + [("no such", "record")]
    sides = [E.read_index(spark, path, [p[i] for p in pairs], 8) for i, path in enumerate(paths)]
    plan = sides[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket#" in plan and "xxhash64" not in plan
    assert scores(E.lookup_scores(*sides, pairs)) == pytest.approx({p: every[p] for p in pairs[:2]})
