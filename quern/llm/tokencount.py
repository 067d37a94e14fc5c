"""Token counts that follow edits.

Every document has a segment tree over blocks of pre-tokens, with the characters and tokens
below each node. Trees are tables: built once, written, and read again to be edited. An edit
encodes only the pre-tokens it touches and their context, up to the next boundary that old
and new text share, and updates the sums above the blocks it changed.

Defined results: a null or empty text has no tokens; null edits are no edits, a null
replacement is empty, places beyond the text are moved to its end; repeated rows are counted
each on their own; an empty table gives no rows; other columns stay, only the output column
replaces one of its name.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quern.llm.bytebpe import encoding, public_ranks
from quern.llm.common import documents, fresh, sliced, stable

BLOCK = 64
_CACHED = 200_000

EDITS = "array<struct<start:int,length:int,text:string>>"


class Counter:
    """Tokens of single pre-tokens, remembered."""

    def __init__(self, ranks: str, pattern: str):
        import regex

        self.pattern = regex.compile(pattern)
        self._encode = encoding(ranks, pattern)._encode_single_piece
        self._known: dict[str, int] = {}

    def __call__(self, piece: str) -> int:
        n = self._known.get(piece)
        if n is None:
            if len(self._known) >= _CACHED:
                self._known.clear()
            n = self._known[piece] = len(self._encode(piece))
        return n

    def all(self, pieces: list[str]) -> list[int]:
        found = list(map(self._known.get, pieces))
        if None in found:
            found = [self(p) if n is None else n for p, n in zip(pieces, found)]
        return found


Block = list[tuple[int, int]] | tuple[np.ndarray, np.ndarray]  # characters and tokens of its pre-tokens


class TokenTree:
    """Pre-tokens of one text in blocks, below a binary tree of their sums.

    A block holds its own part of the text. Blocks that come from a stored tree stay arrays
    until an edit touches them.
    """

    def __init__(self, text: str, count: Counter):
        self.count, self.encoded = count, 0
        pieces = count.pattern.findall(text)
        self._build(text, list(zip(map(len, pieces), count.all(pieces))))

    @classmethod
    def stored(cls, texts: list[str], blocks: list[Block], count: Counter) -> TokenTree:
        """A tree as ``texts`` and ``blocks`` left it; nothing is encoded."""
        tree = cls.__new__(cls)
        tree.count, tree.encoded, tree.texts, tree.blocks = count, 0, texts or [""], blocks or [[]]
        tree._sum_up()
        return tree

    def _build(self, text: str, pieces: list[tuple[int, int]]) -> None:
        self.blocks = [pieces[i : i + BLOCK] for i in range(0, len(pieces), BLOCK)] or [[]]
        ends = list(accumulate(sum(c for c, _ in b) for b in self.blocks))
        self.texts = [text[i:j] for i, j in zip([0, *ends], ends)]
        self._sum_up()

    def _sum_up(self) -> None:
        self.size = 1 << (len(self.blocks) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        for i in range(len(self.blocks)):
            self._leaf(i)
        for node in range(self.size - 1, 0, -1):
            self._sum(node)

    def _leaf(self, i: int) -> None:
        block = self.blocks[i]
        counts = (int(x.sum()) for x in block) if isinstance(block, tuple) else (sum(p[k] for p in block) for k in (0, 1))
        self.chars[self.size + i], self.tokens[self.size + i] = counts

    def _sum(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def _update(self, i: int) -> None:
        self._leaf(i)
        node = self.size + i
        while node > 1:
            node //= 2
            self._sum(node)

    def _open(self, i: int) -> list[tuple[int, int]]:
        block = self.blocks[i]
        if isinstance(block, tuple):
            block = self.blocks[i] = list(zip(block[0].tolist(), block[1].tolist()))
        return block

    @property
    def total(self) -> int:
        return self.tokens[1]

    @property
    def pieces(self) -> int:
        return sum(len(b[0]) if isinstance(b, tuple) else len(b) for b in self.blocks)

    @property
    def text(self) -> str:
        return "".join(self.texts)

    def _first_ending_from(self, place: int) -> tuple[int, int, int, int]:
        """Block, its start, place in the block and start of the first pre-token that ends at ``place`` or later."""
        node, begin = 1, 0
        place = min(place, self.chars[1])
        while node < self.size:
            node *= 2
            if begin + self.chars[node] < place:
                begin += self.chars[node]
                node += 1
        block, start = node - self.size, begin
        for i, (chars, _) in enumerate(self._open(block)):
            if start + chars >= place:
                return block, begin, i, start
            start += chars
        return block, begin, len(self._open(block)), start

    def edit(self, start: int, length: int, text: str) -> None:
        """Replaces ``length`` characters from ``start`` by a text.

        A pre-token is fixed by its characters and the two after it, so those that end more
        than one character before the edit stay. From there pre-tokens are cut anew, in the
        text of as many blocks as it takes, until one ends where an old one ends.
        """
        start = min(max(start, 0), self.chars[1])
        length = min(max(length, 0), self.chars[1] - start)
        first_block, begin, first, at = self._first_ending_from(max(start - 1, 0))
        last, window = first_block, self.texts[first_block]
        while begin + len(window) < start + length:
            last += 1
            window += self.texts[last]
        cut, shift = start - begin, len(text) - length
        window = window[:cut] + text + window[cut + length :]
        head, place = at - begin, at - begin  # in the window
        old, block, i = at, first_block, first  # a boundary of the old text, as far as old pre-tokens were passed
        pieces: list[tuple[int, int]] = []
        while True:
            found = self.count.pattern.match(window, place)
            final = last + 1 >= len(self.blocks)
            if not final and (found is None or found.end() > len(window) - 2):
                last += 1
                window += self.texts[last]
                continue
            if found is None:
                block, i = last, len(self._open(last))
                break
            pieces.append((found.end() - place, self.count(found.group())))
            place = found.end()
            end = begin + place
            if end < start + len(text):
                continue
            while old + shift < end or old < start + length:
                while block < last and i >= len(self._open(block)):
                    block, i = block + 1, 0
                if i >= len(self._open(block)):
                    break
                old += self.blocks[block][i][0]
                i += 1
            if old + shift == end and old >= start + length:
                break
        self.encoded += len(pieces)
        tail = self._open(block)[i:]
        rest = sum(c for c, _ in tail)
        kept_from = len("".join(self.texts[first_block : block + 1])) - rest + shift
        before, after = window[:head], window[kept_from : kept_from + rest]
        changed = window[head:kept_from]
        own = self._open(first_block)[:first] + pieces
        for b in range(first_block + 1, block + 1):
            self.blocks[b], self.texts[b] = [], ""
        if block > first_block:
            self.blocks[block], self.texts[block] = tail, after
            self.blocks[first_block], self.texts[first_block] = own, before + changed
        else:
            self.blocks[block], self.texts[block] = own + tail, before + changed + after
        if len(own) > 4 * BLOCK:
            self._build(self.text, [p for b in range(len(self.blocks)) for p in self._open(b)])
            return
        for b in range(first_block, block + 1):
            self._update(b)


TREE = T.StructType(
    [
        T.StructField("texts", T.ArrayType(T.StringType())),
        T.StructField("sizes", T.ArrayType(T.IntegerType())),  # pre-tokens of each block
        T.StructField("chars", T.ArrayType(T.IntegerType())),
        T.StructField("tokens", T.ArrayType(T.IntegerType())),
    ]
)
_TREE_ARROW = pa.struct([("texts", pa.list_(pa.string())), *[(n, pa.list_(pa.int32())) for n in ("sizes", "chars", "tokens")]])


def _cells(text: str, count: Counter) -> dict:
    """The stored form of the tree of a text, without the tree."""
    pieces = count.pattern.findall(text)
    n = len(pieces)
    chars = np.fromiter(map(len, pieces), np.int32, n)
    ends = [*np.cumsum(chars)[BLOCK - 1 : n - 1 : BLOCK].tolist(), len(text)]
    sizes = np.full(len(ends), BLOCK, np.int32)
    sizes[-1] = n - BLOCK * (len(ends) - 1)
    return {
        "texts": [text[i:j] for i, j in zip([0, *ends], ends)], "sizes": sizes, "chars": chars,
        "tokens": np.array(count.all(pieces), np.int32),
    }


def _dumped(trees: list[TokenTree]) -> pa.Array:
    def cells(tree: TokenTree) -> dict:
        blocks = [tuple(map(list, zip(*b))) if isinstance(b, list) and b else b if b else ([], []) for b in tree.blocks]
        return {
            "texts": tree.texts, "sizes": [len(b[0]) for b in blocks],
            "chars": np.concatenate([np.asarray(b[0], np.int32) for b in blocks]),
            "tokens": np.concatenate([np.asarray(b[1], np.int32) for b in blocks]),
        }

    return pa.array([cells(t) for t in trees], _TREE_ARROW)


def _loaded(column: pa.StructArray, count: Counter) -> Iterator[TokenTree]:
    texts, sizes, chars, tokens = (column.field(i) for i in range(4))
    for i in range(len(column)):
        if not column[i].is_valid:
            yield TokenTree("", count)
            continue
        stops = np.cumsum(sizes[i].values.to_numpy())[:-1]
        parts = [np.split(x[i].values.to_numpy(), stops) for x in (chars, tokens)]
        yield TokenTree.stored(texts[i].as_py(), list(zip(*parts)), count)


def build(
    docs: DataFrame, text: str = "text", out: str = "tree", ranks: str | None = None, pattern: str | None = None
) -> DataFrame:
    """Replaces the text by ``out``, its tree: the texts of its blocks, and characters and tokens of its pre-tokens.

    Write the result; :func:`edited` goes on from there.
    """
    ranks, pattern = _given(ranks, pattern)
    kept = [c for c in docs.columns if c.lower() not in (out.lower(), text.lower())]
    given = fresh(docs, "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = Counter(ranks, pattern)
        for batch in sliced(batches, 256):
            cells = pa.array([_cells(t or "", count) for t in batch.column(len(kept)).to_pylist()], _TREE_ARROW)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], cells], [*kept, out])

    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField(out, TREE)])
    return docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias(given)).mapInArrow(run, schema)


_COUNTS = ("n_tokens", "n_after", "n_pieces", "n_encoded")


def edited(
    trees: DataFrame, edits: Column, tree: str = "tree", out: str = "tokens", ranks: str | None = None,
    pattern: str | None = None, with_trees: bool = True,
) -> DataFrame:
    """Applies ``edits`` to stored trees and adds the struct ``out``: tokens before and after, pre-tokens, and those encoded.

    ``edits`` is a list of ``start, length, text``, applied in turn; places count code points
    of the text as the edits before have left it. Only pre-tokens around an edit are cut and
    encoded. The changed trees take the place of the old ones, or are left out.
    """
    ranks, pattern = _given(ranks, pattern)
    kept = [c for c in trees.columns if c.lower() not in (out.lower(), tree.lower())]
    changes = fresh(trees, "_edits")
    named = [*kept, tree] if with_trees else kept

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = Counter(ranks, pattern)
        for batch in sliced(batches, 256):
            rows, held = [], []
            stored = _loaded(batch.column(len(kept)), count)
            for t, es in zip(stored, batch.column(len(kept) + 1).to_pylist()):
                before, pieces = t.total, t.pieces
                for e in es or ():
                    if e is not None:
                        t.edit(e["start"] or 0, e["length"] or 0, e["text"] or "")
                rows.append(dict(zip(_COUNTS, (before, t.total, pieces, t.encoded))))
                if with_trees:
                    held.append(t)
            values = pa.array(rows, pa.struct([(n, pa.int64()) for n in _COUNTS]))
            columns = [*batch.columns[: len(kept)], *([_dumped(held)] if with_trees else []), values]
            yield pa.RecordBatch.from_arrays(columns, [*named, out])

    counts = T.StructType([T.StructField(n, T.LongType()) for n in _COUNTS])
    schema = T.StructType([*[trees.schema[c] for c in kept], *([T.StructField(tree, TREE)] if with_trees else []), T.StructField(out, counts)])
    return trees.select(
        *[F.col(f"`{c}`") for c in kept], F.col(f"`{tree}`"), edits.cast(EDITS).alias(changes)
    ).mapInArrow(run, schema)


def _given(ranks: str | None, pattern: str | None) -> tuple[str, str]:
    public = public_ranks() if ranks is None or pattern is None else None
    return ranks or public[0], pattern or public[1]


def text_of(tree: Column) -> Column:
    """The text that a stored tree holds."""
    return F.array_join(tree["texts"], "")


def counted(
    docs: DataFrame, edits: Column, text: str = "text", out: str = "tokens",
    ranks: str | None = None, pattern: str | None = None,
) -> DataFrame:
    """Builds the trees of all texts and edits them in one pass, for those who do not keep them.

    Adds ``out`` as :func:`edited` gives it; other columns stay.
    """
    kept = [c for c in docs.columns if c.lower() != out.lower()]
    body, tree, changes = fresh(docs, "_body"), fresh(docs, "_tree"), fresh(docs, "_changes")
    given = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias(body), edits.cast(EDITS).alias(changes))
    done = edited(build(given, body, tree, ranks, pattern), F.col(changes), tree, out, ranks, pattern, with_trees=False)
    return done.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{out}`"))


def sample_edits(text: Column) -> Column:
    """Three edits of a text that follow from it: a deletion, an insertion of its own start, a replacement."""
    n = F.coalesce(F.length(text), F.lit(0))

    def one(start: Column, length: int, new: Column) -> Column:
        return F.struct(start.cast("int").alias("start"), F.lit(length).alias("length"), new.alias("text"))

    return F.array(
        one(F.floor(n / 3), 7, F.lit("")),
        one(F.floor(n / 2), 0, F.substring(text, 1, 12)),
        one(F.floor(n * 3 / 4), 5, F.lit("é 42\n\n x")),
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all documents before and after three edits each, by trees that are written in between."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    trees = stable(build(docs.withColumn("edits", sample_edits(F.col("text")))), compression="zstd")
    return edited(trees, F.col("edits"), with_trees=False).select("doc_id", "tokens.*")
