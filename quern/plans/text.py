"""Queries over word counts, TF-IDF and entity resolution of benchmark items in documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions.text import STOP_WORDS, simple_tokenize, tokenize
from quern.operators import matching as E, text as X
from quern.operators.joins import lookup_join
from quern.operators.rows import exploded
from quern.plans.catalog import query
from quern.plans.data import contained_items, r
from quern.plans.sources import KEPT_TOKENS_SQL, TOKENS_SQL, sql_list
from quern.session import kept, source_version, stable

WORDS_SQL = """
SELECT word FROM (
 SELECT unnest(string_split(trim(regexp_replace(lower(line), '[^a-z0-9 ]', '', 'g'), ' '), ' ')) AS word
 FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)) WHERE word <> ''
"""


@query(f"SELECT word, count(*) AS n FROM ({WORDS_SQL}) GROUP BY word")
def word_count(t):
    return X.word_count(X.lines_of(t.documents, "text"))


@query(f"SELECT word, count(*) AS n FROM ({WORDS_SQL}) GROUP BY word ORDER BY n DESC, word LIMIT 15")
def top_words(t):
    return X.word_count(X.lines_of(t.documents, "text")).orderBy(F.desc("n"), "word").limit(15)


@query(f"""
SELECT (SELECT count(*) FROM ({TOKENS_SQL})) + (
 SELECT count(*) FROM (SELECT unnest(regexp_split_to_array(lower(text), '\\W+')) AS w FROM benchmark) WHERE w <> '') AS tokens
""")
def token_total(t):
    texts = t.documents.select("text").unionAll(t.benchmark.select("text"))
    return X.token_total(texts, simple_tokenize(F.col("text")))


TF_SQL = f"""
SELECT doc_id AS id, token, count(*) / any_value(size) AS tf
FROM (SELECT *, count(*) OVER (PARTITION BY doc_id) AS size FROM ({KEPT_TOKENS_SQL})) GROUP BY 1, 2
"""


@query(f"SELECT id, token, round(tf, 9) AS tf FROM ({TF_SQL})")
def term_frequency(t):
    return X.term_frequency(t.documents, "doc_id", tokenize(F.col("text"))).withColumn("tf", r("tf", 9))


IDF_SQL = f"""
SELECT token, (SELECT count(DISTINCT doc_id) FROM documents) / count(DISTINCT doc_id) AS idf
FROM ({KEPT_TOKENS_SQL}) GROUP BY token
"""


@query(f"SELECT token, round(idf, 6) AS idf FROM ({IDF_SQL})")
def idf(t):
    return X.idf(t.documents, "doc_id", tokenize(F.col("text"))).withColumn("idf", r("idf", 6))


@query(f"SELECT token, idf FROM (SELECT token, round(idf, 6) AS idf FROM ({IDF_SQL})) ORDER BY idf, token LIMIT 11")
def smallest_idf(t):
    idfs = X.idf(t.documents, "doc_id", tokenize(F.col("text"))).withColumn("idf", r("idf", 6))
    return idfs.orderBy("idf", "token").limit(11)


TFIDF_SQL = f"SELECT id, token, tf * idf AS weight FROM ({TF_SQL}) JOIN ({IDF_SQL}) USING (token)"


def _weights(t):
    return X.tfidf(t.documents, "doc_id", tokenize(F.col("text")))


@query(f"SELECT id, token, round(weight, 7) AS weight FROM ({TFIDF_SQL})")
def tfidf(t):
    return _weights(t).withColumn("weight", r("weight", 7))


@query(f"SELECT id, round(sqrt(sum(weight * weight)), 7) AS norm FROM ({TFIDF_SQL}) GROUP BY id")
def doc_norms(t):
    return X.doc_norms(_weights(t)).withColumn("norm", r("norm", 7))


@query(f"SELECT token, count(*) AS postings, sum(id)::BIGINT AS ids FROM ({TFIDF_SQL}) GROUP BY token")
def inverted_index(t):
    index = X.inverted_index(_weights(t))
    return index.groupBy("token").agg(F.count("*").alias("postings"), F.sum("id").alias("ids"))


# Distinct tokens with TF-IDF weights of benchmark items (a) and documents (b), IDF over both.
PAIRS_SQL = f"""
WITH a_tok AS (SELECT * FROM (SELECT item_id AS id, unnest(regexp_split_to_array(lower(text), '\\W+')) AS token FROM benchmark)
               WHERE token <> '' AND token NOT IN ({sql_list(STOP_WORDS)})),
     b_tok AS (SELECT doc_id AS id, token FROM ({KEPT_TOKENS_SQL})),
     tf AS (SELECT side, id, token, count(*) / any_value(size) AS tf FROM (
              SELECT *, count(*) OVER (PARTITION BY side, id) AS size FROM (
                SELECT 'a' AS side, * FROM a_tok UNION ALL SELECT 'b', * FROM b_tok)) GROUP BY 1, 2, 3),
     idf AS (SELECT token, ((SELECT count(*) FROM benchmark) + (SELECT count(*) FROM documents)) / count(*) AS idf
             FROM tf GROUP BY token),
     w AS (SELECT side, id, token, tf * idf AS w FROM tf JOIN idf USING (token)),
     u AS (SELECT side, id, token, w / sqrt(sum(w * w) OVER (PARTITION BY side, id)) AS w FROM w),
     sims AS (SELECT a.id AS id_a, b.id AS id_b, round(sum(a.w * b.w), 9) AS score
              FROM u a JOIN u b ON a.side = 'a' AND b.side = 'b' AND a.token = b.token GROUP BY 1, 2),
     gold AS (SELECT item_id AS id_a, doc_id AS id_b FROM benchmark b JOIN documents d ON contains(d.text, b.text))
"""


def _index(t):
    """Paths of the written vectors of both sides; made once per session and version of the tables."""
    tokens = tokenize(F.col("text"))
    version = source_version(t.benchmark, t.documents)
    made = {}

    def weights(side):
        def write(path):
            if not made:
                made["ab"] = E.pair_weights(t.benchmark, t.documents, "item_id", "doc_id", tokens, tokens, shared=True)
            E.write_index(made["ab"][side], path)

        return write

    return tuple(kept(t.spark, (name, t.dir, version), weights(i)) for i, name in enumerate("ab"))


def _pair_weights(t):
    return tuple(E.read_index(t.spark, path) for path in _index(t))


def _sims(t):
    a, b = _pair_weights(t)
    return E.cosine_pairs_blocked(a, b).withColumn("score", r("score", 9))


def _gold(t):
    """True pairs, written once like the vectors."""

    def write(path):
        found = contained_items(t.documents, t.benchmark)
        found.select(F.col("item_id").alias("id_a"), F.col("doc_id").alias("id_b")).write.parquet(path)

    return t.spark.read.parquet(kept(t.spark, ("gold", t.dir, source_version(t.benchmark, t.documents)), write))


def _bins(t, n):
    """Score counts of all pairs, and the number of true pairs."""
    gold = _gold(t)
    bins = E.weight_bins(*_pair_weights(t), gold, n, digits=9)
    return stable(bins), gold.agg(F.count("*")).scalar()


@query(PAIRS_SQL + "SELECT id_a, id_b, score FROM sims")
def cosine_pairs_blocked(t):
    return _sims(t)


@query(PAIRS_SQL + "SELECT id_a, id_b, score FROM sims WHERE score >= 0.2")
def cosine_pairs_min_score(t):
    a, b = _pair_weights(t)
    return E.cosine_pairs_blocked(a, b, min_score=0.2).withColumn("score", r("score", 9))


@query(PAIRS_SQL + """
SELECT id_a, id_b, score FROM sims JOIN (SELECT * FROM gold ORDER BY id_a, id_b LIMIT 1) USING (id_a, id_b)
""")
def lookup_by_key(t):
    path_a, path_b = _index(t)
    pairs = [tuple(row) for row in _gold(t).orderBy("id_a", "id_b").limit(1).collect()]
    sides = [E.read_index(t.spark, path, [p[i] for p in pairs]) for i, path in enumerate((path_a, path_b))]
    return E.lookup_scores(*sides, pairs).withColumn("score", r("score", 9))


# dotprod, norm and cossim of TF vectors for the true pairs
@query(PAIRS_SQL + """, g AS (SELECT a.tf AS x, b.tf AS y, gold.* FROM gold
  JOIN tf a ON a.side = 'a' AND a.id = id_a JOIN tf b ON b.side = 'b' AND b.id = id_b AND a.token = b.token),
  n AS (SELECT side, id, sqrt(sum(tf * tf)) AS norm FROM tf GROUP BY 1, 2)
SELECT id_a, id_b, round(sum(x * y), 9) AS dot, round(any_value(na.norm), 9) AS norm_a, round(any_value(nb.norm), 9) AS norm_b,
       round(sum(x * y) / any_value(na.norm) / any_value(nb.norm), 9) AS cossim
FROM g JOIN n na ON na.side = 'a' AND na.id = id_a JOIN n nb ON nb.side = 'b' AND nb.id = id_b GROUP BY 1, 2
""")
def cossim(t):
    tokens = tokenize(F.col("text"))
    a = stable(X.term_frequency(t.benchmark, "item_id", tokens).withColumnRenamed("tf", "weight"))
    b = stable(X.term_frequency(t.documents, "doc_id", tokens).withColumnRenamed("tf", "weight"))
    dots = E.score_pairs(a, b, _gold(t)).withColumnRenamed("score", "dot")
    norm_a = X.doc_norms(a).select(F.col("id").alias("id_a"), F.col("norm").alias("norm_a"))
    norm_b = X.doc_norms(b).select(F.col("id").alias("id_b"), F.col("norm").alias("norm_b"))
    both = lookup_join(lookup_join(dots, norm_a, "id_a"), norm_b, "id_b")
    cosine = F.col("dot") / F.col("norm_a") / F.col("norm_b")
    return both.select(
        "id_a", "id_b", *[r(c, 9).alias(c) for c in ("dot", "norm_a", "norm_b")], r(cosine, 9).alias("cossim")
    )


@query(PAIRS_SQL + """
SELECT a.id AS id_a, b.id AS id_b, string_agg(a.token, ' ' ORDER BY a.token) AS tokens
FROM tf a JOIN tf b ON a.side = 'a' AND b.side = 'b' AND a.token = b.token GROUP BY 1, 2
""")
def token_block_join(t):
    tokens = F.array_distinct(tokenize(F.col("text")))
    a = exploded(t.benchmark, F.col("item_id").alias("id"), token=tokens)
    b = exploded(t.documents, F.col("doc_id").alias("id"), token=tokens)
    return E.token_block_join(a, b).withColumn("tokens", F.array_join("tokens", " "))


@query(PAIRS_SQL + """
SELECT (SELECT count(*) FROM gold) AS true_pairs,
       round((SELECT sum(score) FROM sims JOIN gold USING (id_a, id_b)) / (SELECT count(*) FROM gold), 7) AS mean_true,
       round((SELECT sum(score) FROM sims ANTI JOIN gold USING (id_a, id_b)) /
             ((SELECT count(*) FROM benchmark) * (SELECT count(*) FROM documents) - (SELECT count(*) FROM gold)), 7) AS mean_other
""")
def gold_evaluation(t):
    n_pairs = t.benchmark.agg(F.count("*")).scalar() * t.documents.agg(F.count("*")).scalar()
    result = E.evaluated(*_bins(t, 1), n_pairs)
    return result.select("true_pairs", r("mean_true", 7).alias("mean_true"), r("mean_other", 7).alias("mean_other"))


@query(PAIRS_SQL + """
SELECT bin, sum(w)::BIGINT AS n FROM (
 SELECT floor(score * 100)::BIGINT AS bin, 1 AS w FROM sims UNION ALL
 SELECT floor(coalesce(score, 0) * 100)::BIGINT, -1 FROM gold LEFT JOIN sims USING (id_a, id_b) UNION ALL
 SELECT i, 0 FROM range(101) r(i)) GROUP BY bin
""")
def bin_counts(t):
    return E.other_counts(*_bins(t, 100))


@query(PAIRS_SQL + """, g AS (SELECT coalesce(score, 0) AS score FROM gold LEFT JOIN sims USING (id_a, id_b)),
 bins AS (SELECT floor(score * 100) AS bin, 1 AS w FROM sims UNION ALL SELECT floor(score * 100), -1 FROM g),
 th AS (SELECT i / 100 AS threshold, i FROM range(100) r(i)),
 c AS (SELECT threshold, coalesce((SELECT sum(w) FROM bins WHERE bin >= i), 0)::BIGINT AS fp,
              (SELECT count(*) FROM g WHERE score < threshold) AS fn, (SELECT count(*) FROM g) AS gold FROM th),
 p AS (SELECT *, gold - fn AS tp, (gold - fn) / nullif(gold - fn + fp, 0) AS precision, (gold - fn) / gold AS recall FROM c)
SELECT threshold, tp, fp, fn, coalesce(round(precision, 9), 0) AS precision, round(recall, 9) AS recall,
       coalesce(round(2 * recall * precision / nullif(recall + precision, 0), 9), 0) AS f FROM p
""")
def threshold_sweep(t):
    swept = E.swept(*_bins(t, 100))
    # thresholds above every score have no precision
    return swept.withColumns({c: F.coalesce(r(c, 9), F.lit(0.0)) for c in ("precision", "recall", "f")})
