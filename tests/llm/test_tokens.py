"""Encoding, edit-aware counts, packing and the pipeline against the tokenizer libraries and brute force."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from quern.llm import bytebpe, packing, secrets, simhash, tokencount
from quern.llm.queries import QUERIES

PARTS = ["a", " ", "\n", "  ", "\n\n", "'s", "'", "re", "1", "é", "!!", "word and ", " x", "日本", "\U0001f600", "'LL", " ", "İ", "é", "\x1c"]
ODD = [None, "", " ", "\n\n", "a" * 3000, "x y\n\n\nz  " * 200, "don't we'll I've  " * 100, " " * 1500, "word " + "\n" * 700 + "next" * 100, "a'" * 900]


def mixed(n, seed=2):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.choice((1, 5, 80, 700)))) for _ in range(n)]


@pytest.fixture(scope="module")
def bpe():
    return bytebpe.encoding(*bytebpe.public_ranks())


@pytest.fixture(scope="module")
def docs(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


def table(spark, texts):
    return spark.createDataFrame([(i, t, t) for i, t in enumerate(texts)], "doc_id bigint, text string, ids string")


@pytest.mark.parametrize("chunk, overlap", [(100, 16), (64, 40), (333, 8), (1 << 16, 512)])
def test_chunks_encode_as_the_whole_text(spark, docs, bpe, chunk, overlap):
    texts = ODD + mixed(40) + [r.text[:3000] for r in docs.limit(40).collect()]
    df = table(spark, texts)
    encoded = bytebpe.encode(df, chunk=chunk, overlap=overlap)
    got = {r.doc_id: r for r in bytebpe.decode(encoded).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i].ids == bpe.encode_ordinary(t or "") and bytes(got[i].bytes) == (t or "").encode()


def test_repeated_and_null_ids_are_encoded_each(spark):
    df = spark.createDataFrame([(1, "ab " * 100), (1, "ab " * 100), (None, "ab " * 100), (None, None)], "doc_id int, text string")
    sizes = sorted(len(r.ids) for r in bytebpe.encode(df, chunk=50, overlap=10).collect())
    assert len(sizes) == 4 and sizes[0] == 0 and sizes[1] == sizes[3] > 0
    assert bytebpe.encode(df.limit(0)).count() == 0


def test_byte_bpe_query(spark, data, docs, bpe):
    got = {r.doc_id: r.n_tokens for r in QUERIES["op4_byte_bpe"](spark, data).collect()}
    assert got == {r.doc_id: len(bpe.encode_ordinary(r.text or "")) for r in docs.collect()}


def test_edits_keep_the_count(docs, bpe):
    count = tokencount.Counter(*bytebpe.public_ranks())
    rng = random.Random(3)
    texts = [r.text for r in docs.limit(20).collect()] + mixed(60)
    for text in texts:
        tree = tokencount.TokenTree(text, count)
        for _ in range(10):
            start, length = rng.randint(0, len(text) + 1), rng.choice((0, 0, 1, 2, 5, 30, 400))
            new = "".join(rng.choice(PARTS) for _ in range(rng.choice((0, 1, 2, 8, 300))))
            at = min(start, len(text))
            text = text[:at] + new + text[at + length :]
            tree.edit(start, length, new)
            assert tree.text == text and tree.total == len(bpe.encode_ordinary(text))


def test_edit_query_encodes_little(spark, data, docs, bpe):
    rows = {r.doc_id: r for r in QUERIES["op6_token_counts"](spark, data).collect()}
    for d in docs.collect():
        t = d.text or ""
        n = len(t)
        e = t[: n // 3] + t[n // 3 + 7 :]
        e = e[: n // 2] + t[:12] + e[n // 2 :]
        e = e[: n * 3 // 4] + "é 42\n\n x" + e[n * 3 // 4 + 5 :]
        assert rows[d.doc_id].n_tokens == len(bpe.encode_ordinary(t)) and rows[d.doc_id].n_after == len(bpe.encode_ordinary(e))
        assert rows[d.doc_id].n_encoded < 60


def test_stored_trees_go_on_from_where_they_were(spark, docs, bpe):
    from pyspark.sql import functions as F

    rng = random.Random(8)
    texts = [r.text for r in docs.limit(15).collect()] + mixed(30) + ["", None, "a" * 5000, " \n" * 900]
    df = spark.createDataFrame([(i, t, "t") for i, t in enumerate(texts)], "doc_id int, text string, tokens string")
    trees = tokencount.build(df)
    assert trees.columns == ["doc_id", "tokens", "tree"]
    assert {r.doc_id: r.t for r in trees.select("doc_id", tokencount.text_of(F.col("tree")).alias("t")).collect()} == {i: t or "" for i, t in enumerate(texts)}
    for _ in range(3):  # written and read again each time
        trees = tokencount.stable(trees)
        edits = {i: [(rng.randint(-2, len(t or "") + 3), rng.choice((0, 1, 9, 700)), "".join(rng.choice(PARTS) for _ in range(rng.choice((0, 1, 40))))) for _ in range(rng.randrange(4))] for i, t in enumerate(texts)}
        asked = trees.drop("tokens").join(spark.createDataFrame(list(edits.items()), f"doc_id int, e {tokencount.EDITS}"), "doc_id")
        done = tokencount.stable(tokencount.edited(asked, F.col("e")))
        before = [len(bpe.encode_ordinary(t or "")) for t in texts]
        for i, es in edits.items():
            for start, length, new in es:
                t = texts[i] or ""
                at = min(max(start, 0), len(t))
                texts[i] = t[:at] + new + t[at + length :]
        for r in done.select("doc_id", "tokens.*", tokencount.text_of(F.col("tree")).alias("t")).collect():
            assert r.t == (texts[r.doc_id] or "") and (r.n_tokens, r.n_after) == (before[r.doc_id], len(bpe.encode_ordinary(r.t)))
            assert edits[r.doc_id] or r.n_encoded == 0
        trees = done.drop("e")
    assert tokencount.build(df.limit(0)).count() == 0


def test_edits_of_odd_rows(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(
        [(None, None), ("", [(5, 5, None)]), ("ab cd", None), ("ab cd", [(-3, None, "x"), None, (99, 99, " y")])],
        f"text string, tokens {tokencount.EDITS}",
    )
    got = tokencount.counted(df, F.col("tokens"), out="n").collect()
    assert [(r.n.n_tokens, r.n.n_after) for r in got][:3] == [(0, 0), (0, 0), (2, 2)] and got[3].n.n_after > 2
    assert tokencount.counted(df.limit(0), F.col("tokens")).count() == 0


@pytest.fixture(scope="module")
def word_bpe():
    tokenizer = Tokenizer.from_file(packing.public_vocabulary())
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def check_packing(rows, expected, length=2048):
    """Every id in one piece, pieces in order, sequences gapless and within their length."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(expected)
    for doc, pieces in by_doc.items():
        ids, at = np.array(expected[doc], "<u4"), 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert zlib.crc32(ids[at : at + p.length].tobytes()) == p.ids_crc32
            at += p.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert 0 < at <= length
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return len(by_sequence)


def test_packing_query(spark, data, docs, word_bpe):
    expected = {r.doc_id: word_bpe(r.text) for r in docs.collect()}
    sequences = check_packing(QUERIES["op10_packing"](spark, data).collect(), expected)
    assert sum(map(len, expected.values())) >= 0.97 * 2048 * sequences


def test_words_encode_as_the_whole_text(word_bpe):
    encode = packing.WordEncoder(packing.public_vocabulary())
    texts = [t or "" for t in ODD] + mixed(300) + ["<|endoftext|> a", "Straße ÀÉ ǅ Σας İi K \x0b\x0c\x85 x"]
    for _ in range(2):  # the second time from what was remembered
        ids, ends = encode(texts)
        got = np.split(ids, ends[:-1])
        assert [g.tolist() for g in got] == [word_bpe(t) for t in texts]


def test_special_tokens_are_what_the_library_makes_of_them(spark, word_bpe):
    encode = packing.WordEncoder(packing.public_vocabulary())
    mark, start = encode.special
    assert {mark, start} == {"<|startoftext|>", "<|endoftext|>"}
    texts = [f"hello {mark} world", f"a{mark}b É{start}é", f"{mark}{start}!", mark.upper() + " x", mark[:-1], f"<|{mark}|>", f"{start[:4]} {start[4:]}", mark * 700]
    ids, ends = encode(texts)
    assert [x.tolist() for x in np.split(ids, ends[:-1])] == [word_bpe(t) for t in texts]
    assert word_bpe("hello <|endoftext|> world") == [3306, 49407, 1002, 1]
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in enumerate(texts)], "doc_id int, text string, length string, ids int, _row int")
    check_packing(packing.packed(df).collect(), {i: word_bpe(t) for i, t in enumerate(texts)})


def test_pack_a_very_long_text(spark, word_bpe):
    text = " ".join(f"word{i % 977} café" for i in range(150_000))
    check_packing(packing.packed(spark.createDataFrame([(1, text)], "doc_id int, text string")).collect(), {1: word_bpe(text)})


def test_pack_odd_rows(spark, word_bpe):
    df = spark.createDataFrame([(1, "b"), (1, "b"), (None, None), (None, ""), (2, "x 1 " * 3000)], "doc_id int, text string")
    rows = packing.packed(df).collect()
    assert sorted(r.length for r in rows if r.doc_id != 2) == [1, 1, 2, 2]
    assert [i for r in sorted((r for r in rows if r.doc_id == 2), key=lambda r: r.start) for i in r.ids] == word_bpe("x 1 " * 3000)
    assert packing.packed(df.limit(0)).count() == 0


def test_plan_takes_every_piece_in_few_sequences():
    rng = random.Random(4)
    for demand in ({256: 3}, {1: 1}, {100: 7, 56: 7}, {s: rng.randint(1, 400) for s in range(1, 257)}):
        plan = packing.plan(demand, 256)
        taken = {}
        for pattern, n in plan.patterns:
            assert sum(u * k for u, k in pattern.items()) <= 256
            for u, k in pattern.items():
                taken[u] = taken.get(u, 0) + k * n
        assert taken == demand
    bound = sum(u * n for u, n in demand.items()) / 256
    assert plan.sequences <= bound * 1.02 + 1
    assert packing.plan({}, 256).patterns == []


@pytest.mark.parametrize("bits", [1, 12])
def test_ranks_in_many_groups(spark, docs, word_bpe, monkeypatch, bits):
    monkeypatch.setattr(packing, "BUNDLE_BITS", bits)
    cut = packing.pieces(docs, with_ids=False)
    rows = packing.assigned(cut, group_rows=20).collect()
    check_packing(rows, {r.doc_id: word_bpe(r.text) for r in docs.collect()})


def test_pipeline_against_stages_by_hand(spark, data, docs, word_bpe):
    kept, seen = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, data).cache()
        assert kept.columns == docs.columns
        gone = {r.doc_id for r in before.collect()} - {r.doc_id for r in kept.collect()}
        seen.append((name, len(gone)))
    assert [n for n, _ in seen] == ["language_id", "quality_rules", "near_duplicates", "secret_scan"]
    assert seen[1][1] > 0 and seen[2][1] > 0 and seen[3][1] == 0
    fps = [simhash.fingerprint(r.text) for r in before.collect()]
    assert all((a ^ b) & (2**64 - 1) and ((a ^ b) & (2**64 - 1)).bit_count() > 3 for i, a in enumerate(fps) for b in fps[:i])
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert not any(secrets.base_spans(t) for t in texts.values())
    assert all(len(r.text) == r.n_chars for r in kept.collect())
    check_packing(corpus_pipeline.run(spark, data).collect(), {i: word_bpe(t) for i, t in texts.items()})


def test_pipeline_keeps_mixtures_of_languages(spark, data, docs):
    words = {x: " ".join(r.text for r in docs.filter(f"lang = '{x}' and n_chars > 500").orderBy("doc_id").limit(5).collect()).split() for x in ("en", "fr", "de")}
    assert all(len(w) >= 450 for w in words.values())
    mixed = " ".join(words["en"][:450] + words["fr"][:300] + words["de"][:250])
    even = " ".join(words["en"][:250] + words["fr"][:250])
    rows = [(10**9 + i, t, None, "test", len(t)) for i, t in enumerate([mixed, even, "12 34 !?"])]
    kept = corpus_pipeline.language_id(spark, docs.union(spark.createDataFrame(rows, docs.schema)), data)
    assert {r.doc_id for r in kept.filter("doc_id >= 1000000000").collect()} == {10**9, 10**9 + 1}


def test_pipeline_of_a_very_long_text(spark, data, docs, word_bpe):
    rng = random.Random(4)
    words = [w for r in docs.filter("lang = 'en' and n_chars > 300").limit(20).collect() for w in r.text.split()]
    text = "\n".join(" ".join(f"{rng.choice(words)}{rng.randrange(99)}" for _ in range(12)) + "." for _ in range(9_000))
    long = spark.createDataFrame([(10**9, text, "en", "long", len(text)), (10**9 + 1, None, None, None, None)], docs.schema)
    kept = docs.limit(30).union(long)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = simhash.stable(stage(spark, kept, data))
    last = {r.doc_id: r.text for r in kept.collect()}
    assert 10**9 in last and 10**9 + 1 not in last and len(last[10**9]) > 0.9 * len(text)
    check_packing(corpus_pipeline.STAGES[-1][1](spark, kept, data).collect(), {i: word_bpe(t) for i, t in last.items()})


def test_tree_of_a_very_long_text(bpe):
    count = tokencount.Counter(*bytebpe.public_ranks())
    text = "".join(random.Random(1).choice(PARTS) + " " for _ in range(120_000))
    tree = tokencount.TokenTree(text, count)
    tree.edit(len(text) // 2, 9, "inserted")
    assert tree.total == len(bpe.encode_ordinary(text[: len(text) // 2] + "inserted" + text[len(text) // 2 + 9 :])) and tree.encoded < 60


def test_written_pipeline_leaves_no_tables_behind(spark, data, tmp_path):
    from quern import session

    corpus_pipeline.write(spark, data, str(tmp_path / "packed"))
    assert spark.read.parquet(str(tmp_path / "packed")).count() > 0 and not session._written


def test_pipeline_of_odd_tables(spark, docs):
    extra = docs.limit(0).selectExpr("*", "1 AS _fp", "'x' AS _quality")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, extra, "").columns == extra.columns
    assert corpus_pipeline.STAGES[-1][1](spark, extra, "").count() == 0
