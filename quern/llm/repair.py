"""Conversation structure repair: cheapest edits by bidirectional Dijkstra over an edit lattice.

A node of the lattice is a number of rows read and the state of the structure so far. Rows
are kept, given another role, or deleted, and empty turns inserted, until the roles read
``(s?(ua)+)?`` by their initials. A forward and a reverse heap meet; all crossings of the
least cost are finished, and of their audits, the initials of the edits, the least in ASCII
order is taken.

Rows are ordered by range partitions, without their texts, and cut into blocks, so that a
conversation may fill many tasks. One that lies in a single block is solved at once; else
each block gives the cheapest edits between every two states, and sixteen neighbours at a
time are joined into one until a row per conversation is left. Texts are shuffled once, next
to the edits they get.

Defined results: a null role or text is one space; a null conversation id is an id like any
other; rows of one turn are ordered by role and then by the digest of role and text; other
roles than system, user and assistant count by their initial; a conversation without rows
has no faults, no edits and the hash of the empty text; other columns are ignored; an empty
table gives no rows. Equal role and text means an equal SHA-256 of both.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quern.llm.common import stable
from quern.operators.ordering import zip_with_index

RUBRIC = {"K": 0, "R": 3, "D": 4, "I": 3}  # cost of each edit
CUT_SHORT = 3  # added where a truncated row stays
BLOCK_BITS = 8  # a block is up to 2**8 rows
FAN_BITS = 4  # blocks joined at a time: 2**4
PIECE_BYTES = 4 << 20  # of the text of a conversation that several tasks share

START, SYSTEM, USER, ASSISTANT = STATES = range(4)  # what the structure so far ends with
DONE = (START, ASSISTANT)
_LEGAL = ("su", "ua", "au")
_BLANKS = r" \t\n\x0B\f\r"


def _turned(state: int) -> int:
    """The state after the turn that must follow, if it is not of the system."""
    return ASSISTANT if state == USER else USER


def _kept(initial: str, state: int) -> int | None:
    if initial == "s":
        return SYSTEM if state == START else None
    after = _turned(state)
    return after if initial == ("a" if after == ASSISTANT else "u") else None


def _edits(row: tuple[str, str], state: int) -> Iterator[tuple[str, int, int]]:
    """Letter, cost and next state of the edits of a row ``(initial, fault)``."""
    initial, fault = row
    yield "D", RUBRIC["D"], state
    if fault not in ("blank", "duplicate"):
        more = CUT_SHORT if fault == "truncated" else 0
        after = _kept(initial, state)
        if after is not None:
            yield "K", RUBRIC["K"] + more, after
        yield "R", RUBRIC["R"] + more, _turned(state)


def cheapest(rows: Sequence[tuple[str, str]], start: int = START, ends: Sequence[int] = DONE) -> tuple[int, str] | None:
    """Least cost and least audit from state ``start`` to one of ``ends``; None if there is no way.

    Only keeping a row is free, so nodes of one cost are settled in the order of their rows:
    a settled label has the least audit. Of two ways of one cost to a node neither audit
    begins with the other, so that the least of a whole is made of least parts.
    """
    n = len(rows)
    forward: dict[tuple[int, int], tuple[int, str]] = {(0, start): (0, "")}
    reverse: dict[tuple[int, int], tuple[int, str]] = {(n, end): (0, "") for end in ends}
    heads, tails = [(0, 0, start)], [(0, -n, end) for end in ends]
    heapq.heapify(tails)
    before = [[] for _ in range(n)]  # reverse edges of each row, by the state after it
    best = None

    def meet(node: tuple[int, int]) -> None:
        nonlocal best
        if node in forward and node in reverse:
            total = forward[node][0] + reverse[node][0]
            best = total if best is None else min(best, total)

    def relax(labels: dict, heap: list, node: tuple[int, int], label: tuple[int, str], key: int) -> None:
        old = labels.get(node)
        if old is None or label < old:
            labels[node] = label
            if old is None or label[0] < old[0]:
                heapq.heappush(heap, (label[0], key, node[1]))
            meet(node)

    for end in ends:
        meet((n, end))
    while heads and tails and (best is None or heads[0][0] + tails[0][0] <= best):
        if heads[0][0] <= tails[0][0]:
            cost, i, state = heapq.heappop(heads)
            if forward[i, state][0] < cost:
                continue
            audit = forward[i, state][1]
            after = _turned(state)
            relax(forward, heads, (i, after), (cost + RUBRIC["I"], audit + "I"), i)
            if i < n:
                for letter, price, to in _edits(rows[i], state):
                    relax(forward, heads, (i + 1, to), (cost + price, audit + letter), i + 1)
        else:
            cost, minus, state = heapq.heappop(tails)
            i = -minus
            if reverse[i, state][0] < cost:
                continue
            audit = reverse[i, state][1]
            for origin in STATES:
                if _turned(origin) == state:
                    relax(reverse, tails, (i, origin), (cost + RUBRIC["I"], "I" + audit), -i)
            if i:
                if not before[i - 1]:
                    before[i - 1] = [(origin, *edit) for origin in STATES for edit in _edits(rows[i - 1], origin)]
                for origin, letter, price, to in before[i - 1]:
                    if to == state:
                        relax(reverse, tails, (i - 1, origin), (cost + price, letter + audit), 1 - i)
    if best is None:
        return None
    crossings = (forward[v][1] + r[1] for v, r in reverse.items() if v in forward and forward[v][0] + r[0] == best)
    return best, min(crossings)


Cells = list[tuple[int, str] | None]  # of each pair of states, the first one slower


def joined(left: Cells, right: Cells) -> Cells:
    """Cheapest edits of two neighbours, from those of each."""
    cells: Cells = []
    for s in STATES:
        for t in STATES:
            ways = [
                (a[0] + b[0], a[1] + b[1])
                for m in STATES
                if (a := left[4 * s + m]) is not None and (b := right[4 * m + t]) is not None
            ]
            cells.append(min(ways, default=None))
    return cells


def pieces(audit: str, sizes: Sequence[int]) -> list[str]:
    """The audit cut into that of each block; insertions go with the row after them, the last ones with the last block."""
    out, at = [], 0
    for size in sizes:
        begin = at
        while size:
            size -= audit[at] != "I"
            at += 1
        out.append(audit[begin:at])
    out[-1] += audit[at:]
    return out


def faulty(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, key, initial, fault, seq`` of all rows, in order by ``seq``; duplicates are not known yet."""
    last = F.regexp_extract("text", rf"([^{_BLANKS}])[{_BLANKS}]*\z", 1)
    fault = F.when(last == "", "blank").when(last.rlike(r"\A[.!?]\z"), "").otherwise("truncated")
    slim = rows.select("conv_id", "turn", "role", _key(), F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))
    order = ["conv_id", "turn", "role", "key", "row"]
    unique = slim.withColumn("row", F.monotonically_increasing_id())  # cuts many equal rows over partitions
    sorted_rows = unique.repartitionByRange(*order).sortWithinPartitions(*order).drop("row")
    return stable(sorted_rows.withColumn("seq", F.monotonically_increasing_id()))


def _key() -> Column:
    return F.unhex(F.sha2(F.concat(F.col("role"), F.lit("\0"), F.col("text")).cast("binary"), 256)).alias("key")


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def blocks(rows: DataFrame) -> DataFrame:
    """``conv_id, block, rows`` of at most ``2**BLOCK_BITS`` rows each, with their faults."""
    placed = faulty(rows)
    repeats = placed.groupBy("conv_id", "key").agg(F.min("seq").alias("first"), F.count("*").alias("n")).filter("n > 1")
    repeats = stable(repeats.select(F.col("conv_id").alias("c"), F.col("key").alias("k"), "first"))
    marked = placed.join(repeats, _same(F.col("conv_id"), F.col("c")) & (F.col("key") == F.col("k")), "left")
    again = (F.col("fault") != "blank") & (F.col("seq") > F.col("first"))
    row = F.struct("seq", "turn", "role", "key", "initial", F.when(again, "duplicate").otherwise(F.col("fault")).alias("fault"))
    # the upper bits of seq are the partition, so that a block never crosses one
    return marked.groupBy("conv_id", F.shiftright("seq", BLOCK_BITS).alias("_b")).agg(
        F.sort_array(F.collect_list(row)).alias("rows")
    ).select("conv_id", F.col("rows")[0]["seq"].alias("block"), "rows")


CELL = "struct<cost:bigint,audit:string>"
SUMS = ("illegal", "blank", "duplicate", "truncated")
PART = f"blocks array<struct<block:bigint,n:int>>, cells array<{CELL}>, first string, last string, " + ", ".join(f"{c} bigint" for c in SUMS)


def _illegal(a: str, b: str) -> bool:
    return a + b not in _LEGAL


def _arrays(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


def _arrow_schema(kinds: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(kinds)


def _solved(cut: DataFrame) -> DataFrame:
    """``conv_id, idx`` and what is known of a block: one cell if the block is the whole conversation, else all."""
    kinds = T.StructType([cut.schema["conv_id"], T.StructField("idx", T.LongType()), *T._parse_datatype_string(PART).fields])
    schema = _arrow_schema(kinds)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, idx, block, rows in zip(*[c.to_pylist() for c in batch.columns]):
                marks = [(r["initial"], r["fault"]) for r in rows]
                initials = [m[0] for m in marks]
                if idx is None:
                    found = [cheapest(marks)]
                else:
                    found = [cheapest(marks, s, (t,)) for s in STATES for t in STATES]
                out.append(
                    {
                        "conv_id": conv, "idx": idx, "blocks": [{"block": block, "n": len(rows)}],
                        "cells": [c and {"cost": c[0], "audit": c[1]} for c in found],
                        "first": initials[0], "last": initials[-1],
                        "illegal": sum(map(_illegal, initials, initials[1:])),
                        **{f: sum(m[1] == f for m in marks) for f in SUMS[1:]},
                    }
                )
            yield _arrays(out, schema)

    return cut.select("conv_id", "idx", "block", "rows").mapInArrow(solve, kinds)


def _met(parts: DataFrame) -> DataFrame:
    """Joins the neighbours whose numbers differ in the last ``FAN_BITS`` only."""
    kinds = parts.schema
    schema = _arrow_schema(kinds)
    names = [c for c in parts.columns if c not in ("conv_id", "idx")]
    grouped = parts.groupBy("conv_id", F.shiftright("idx", FAN_BITS).alias("to")).agg(
        F.sort_array(F.collect_list(F.struct("idx", *names))).alias("parts")
    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for conv, to, found in zip(*[c.to_pylist() for c in batch.columns]):
                whole = found[0]
                cells: Cells = [c and (c["cost"], c["audit"]) for c in whole["cells"]]
                for part in found[1:]:
                    cells = joined(cells, [c and (c["cost"], c["audit"]) for c in part["cells"]])
                    whole["illegal"] += _illegal(whole["last"], part["first"])
                    whole["last"] = part["last"]
                    whole["blocks"] += part["blocks"]
                    for c in SUMS:
                        whole[c] += part[c]
                whole |= {"conv_id": conv, "idx": to, "cells": [c and {"cost": c[0], "audit": c[1]} for c in cells]}
                yield _arrays([whole], schema)

    return grouped.mapInArrow(meet, kinds)


def solved(cut: DataFrame) -> DataFrame:
    """``conv_id, cost, audit`` and fault counts of each conversation, with the audit of each of its blocks.

    Takes the stored table of :func:`blocks`.
    """
    many = cut.groupBy("conv_id").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("conv_id").alias("c"))
    split = stable(cut.select("conv_id", "block").join(stable(many), _same(F.col("conv_id"), F.col("c")), "left_semi"))
    numbers = stable(zip_with_index(split, ["conv_id", "block"], "idx").select(F.col("block").alias("b"), "idx"))
    parts = stable(_solved(cut.join(numbers, F.col("block") == F.col("b"), "left")))
    whole, left = parts.filter("idx is null"), parts.filter("idx is not null")
    while left.groupBy("conv_id").agg(F.count("*").alias("n")).filter("n > 1").limit(1).count():
        left = stable(_met(left))
    done = [s for s in DONE]
    ends = F.filter(F.array(*[F.col("cells")[F.lit(s)] for s in done]), lambda c: c.isNotNull())
    return stable(
        whole.withColumn("way", F.col("cells")[0]).unionAll(left.withColumn("way", F.array_min(ends))).select(
            "conv_id", "blocks", F.col("way.cost").alias("cost"), F.col("way.audit").alias("audit"), *SUMS
        )
    )


def edited(cut: DataFrame, ways: DataFrame) -> DataFrame:
    """The lines of each repaired conversation: ``conv_id, turn, role, key, no, of, said, keeps``.

    ``no`` counts the ``of`` lines of a conversation from 0 and ``said`` is the role each gets;
    ``turn, role, key`` name the row a line stands at, whose text it has if it ``keeps`` one.
    """
    named = T.StructType([T.StructField("block", T.LongType()), T.StructField("piece", T.StringType()), T.StructField("no", T.LongType()), T.StructField("of", T.LongType())])
    piece_schema = _arrow_schema(named)

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held, audit in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                no, of, out = 0, len(audit) - audit.count("D"), []
                for block, piece in zip(held, pieces(audit, [b["n"] for b in held])):
                    out.append({"block": block["block"], "piece": piece, "no": no, "of": of})
                    no += len(piece) - piece.count("D")
                yield _arrays(out, piece_schema)

    given = stable(ways.select("blocks", "audit").mapInArrow(shared, named)).withColumnRenamed("block", "b")
    row = cut.schema["rows"].dataType.elementType
    kinds = T.StructType([cut.schema["conv_id"], row["turn"], row["role"], row["key"], T.StructField("no", T.LongType()),
                          T.StructField("of", T.LongType()), T.StructField("said", T.StringType()), T.StructField("keeps", T.BooleanType())])
    line_schema = _arrow_schema(kinds)

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, rows, piece, no, of in zip(*[c.to_pylist() for c in batch.columns]):
                at = 0
                for letter in piece:
                    row = rows[min(at, len(rows) - 1)]
                    due = "user" if (no - of % 2) % 2 == 0 else "assistant"  # an odd number of lines begins with the system
                    if letter != "D":
                        said = row["role"] if letter == "K" else due
                        out.append({"conv_id": conv, **{c: row[c] for c in ("turn", "role", "key")}, "no": no, "of": of, "said": said, "keeps": letter != "I"})
                        no += 1
                    at += letter != "I"
            yield _arrays(out, line_schema)

    met = cut.join(given, F.col("block") == F.col("b")).select("conv_id", "rows", "piece", "no", "of")
    return met.mapInArrow(lines, kinds)


def _hashed(conv_kind: T.StructField):
    """Streams ``conv_id, no, of, said, keeps, text`` in order; a conversation of one task is hashed, pieces of others go on."""
    kinds = T.StructType([conv_kind, T.StructField("no", T.LongType()), T.StructField("sha256", T.StringType()), T.StructField("piece", T.BinaryType())])
    schema = _arrow_schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text, conv, first, of, held, size = "", None, None, 0, [], 0

        def close(whole: bool) -> Iterator[pa.RecordBatch]:
            if first is None:
                return
            data = b"".join(held)
            sha = hashlib.sha256(data).hexdigest() if whole else None
            yield _arrays([{"conv_id": conv, "no": first, "sha256": sha, "piece": None if whole else data}], schema)

        for batch in batches:
            for row in batch.to_pylist():
                if row["no"] < 0:
                    text = row["text"]
                    continue
                if first is not None and (row["conv_id"] != conv or size > PIECE_BYTES):
                    yield from close(False)
                    first = None
                if first is None:
                    conv, first, of, held, size = row["conv_id"], row["no"], row["of"], [], 0
                line = ("\n" if row["no"] else "") + row["said"] + ":" + (text if row["keeps"] else "")
                held.append(line.encode())
                size += len(held[-1])
                if row["no"] == of - 1:
                    yield from close(first == 0)
                    first = None
        yield from close(False)

    return run, kinds


def _chained(conv_kind: T.StructField):
    """Hashes the pieces of each conversation in order, one piece in memory at a time."""
    kinds = T.StructType([conv_kind, T.StructField("sha256", T.StringType())])
    schema = _arrow_schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, sha = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                own = batch.column(0)[i].as_py()
                if sha is None or own != conv:
                    if sha is not None:
                        yield _arrays([{"conv_id": conv, "sha256": sha.hexdigest()}], schema)
                    conv, sha = own, hashlib.sha256()
                sha.update(batch.column(1)[i].as_py())
        if sha is not None:
            yield _arrays([{"conv_id": conv, "sha256": sha.hexdigest()}], schema)

    return run, kinds


def hashes(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """``conv_id, sha256`` of the repaired ``role:text`` lines of each conversation that has any.

    Range partitions by row bring each text next to its line; a conversation over several
    partitions is hashed from pieces of a few megabytes.
    """
    texts = rows.select("conv_id", "turn", "role", _key(), F.lit(-1).cast("bigint").alias("no"), F.lit(0).cast("bigint").alias("of"),
                        F.lit("").alias("said"), F.lit(False).alias("keeps"), "text")
    place = ["conv_id", "turn", "role", "key"]
    both = texts.unionByName(lines.withColumn("text", F.lit("")))
    run, kinds = _hashed(rows.schema["conv_id"])
    ordered = both.repartitionByRange(*place).sortWithinPartitions(*place, "no")
    found = stable(ordered.select("conv_id", "no", "of", "said", "keeps", "text").mapInArrow(run, kinds))
    chain, ended = _chained(rows.schema["conv_id"])
    left = found.filter("sha256 is null").repartition("conv_id").sortWithinPartitions("conv_id", "no")
    return found.filter("sha256 is not null").select("conv_id", "sha256").unionAll(left.select("conv_id", "piece").mapInArrow(chain, ended))


def repaired(rows: DataFrame) -> DataFrame:
    """``conv_id, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of each conversation of ``conv_id, turn, role, text``."""
    filled = rows.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"),
        *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")],
    )
    cut = stable(blocks(filled))
    ways = solved(cut)
    # written, as range partitions read their rows twice
    sha = hashes(filled, stable(edited(cut, ways))).select(F.col("conv_id").alias("c"), "sha256")
    met = ways.join(sha, _same(F.col("conv_id"), F.col("c")), "left")
    digest = F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256))
    return met.select("conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit", digest.alias("repaired_sha256"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, left without their stops, repeated or given to the user, as the checksum of id and turn says."""
    space = F.lit(" ")
    name = F.concat(*[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id",)], F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    hurt = conversations.select(
        "conv_id", "turn", *[F.coalesce(F.col(c), space).alias(c) for c in ("role", "text")], (F.crc32(name.cast("binary")) % 20).alias("hurt")
    )
    kind = F.col("hurt")
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    left = hurt.filter(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), kind)
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return left.select("conv_id", "turn", "role", "text", copies.alias("copy")).drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = damaged(source)
    turns = rows.groupBy("conv_id", F.col("turn").cast("bigint").alias("turn")).agg(F.lit(1).alias("one"))
    spans = turns.groupBy(F.col("conv_id").alias("s")).agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps")
    )
    found = repaired(rows).withColumnRenamed("conv_id", "r")
    every = source.select("conv_id").distinct()
    met = every.join(spans, _same(F.col("conv_id"), F.col("s")), "left").join(found, _same(F.col("conv_id"), F.col("r")), "left")
    zero = F.lit(0).cast("bigint")
    empty = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit("").cast("binary"), 256)}
    return met.select(
        "conv_id", *[F.coalesce(F.col(c).cast("bigint"), zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        *[F.coalesce(F.col(c), v).alias(c) for c, v in empty.items()],
    )


def _way(state: str, letter: str, price: str | int, when: str = "TRUE") -> str:
    return f"CASE WHEN {when} THEN {{'c': {state}.c + {price}, 'a': {state}.a || '{letter}'}} ELSE {{'c': {_FAR}, 'a': ''}} END"


def _least(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


_FAR = "1000000000::BIGINT"
_STAYS = "fault NOT IN ('blank', 'duplicate')"
_KEEP, _REROLE = f"CASE fault WHEN 'truncated' THEN {CUT_SHORT} ELSE 0 END", f"({RUBRIC['R']} + CASE fault WHEN 'truncated' THEN {CUT_SHORT} ELSE 0 END)"


def _row_sql() -> str:
    """The states after a row, before insertions."""
    drop = {s: _way(f"s{s}", "D", RUBRIC["D"]) for s in STATES}
    free = (START, SYSTEM, ASSISTANT)
    said = [_way(f"s{s}", "K", _KEEP, f"{_STAYS} AND initial = 'u'") for s in free] + [_way(f"s{s}", "R", _REROLE, _STAYS) for s in free]
    answers = [_way("s2", "K", _KEEP, f"{_STAYS} AND initial = 'a'"), _way("s2", "R", _REROLE, _STAYS)]
    return f"""{drop[START]} AS b0, {_least(drop[SYSTEM], _way("s0", "K", _KEEP, f"{_STAYS} AND initial = 's'"))} AS b1,
      {_least(drop[USER], *said)} AS b2, {_least(drop[ASSISTANT], *answers)} AS b3"""


#: One row of a conversation at a time, all four states at once; checksums byte by byte.
OP11_SQL = rf"""
WITH RECURSIVE t AS (SELECT list_transform(range(256), lambda c: list_reduce([c, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t),
c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             xor(list_reduce([4294967295] || list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                                                            lambda x: ascii(x)::BIGINT),
                             lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS kind FROM conversations, t),
d AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
             CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(CASE kind WHEN 0 THEN []::INT[] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM c),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(role || chr(0) || text), copy) AS i,
             rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM d),
f AS (SELECT conv_id, turn, role, text, i, left(role, 1) AS initial,
             CASE WHEN body = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                  WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
             lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM n),
u AS (SELECT conv_id, count(*) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
             count(*) FILTER (fault = 'truncated') AS truncated,
             count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
it AS (SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': ''}} AS s0, {{'c': {_FAR}, 'a': ''}} AS s1,
              {{'c': {RUBRIC["I"]}::BIGINT, 'a': 'I'}} AS s2, {{'c': {2 * RUBRIC["I"]}::BIGINT, 'a': 'II'}} AS s3 FROM u UNION ALL
       SELECT conv_id, i, b0, b1, u2, {_least("b3", _way("u2", "I", RUBRIC["I"]))}
       FROM (SELECT *, {_least("b2", *[_way(f"b{s}", "I", RUBRIC["I"]) for s in (START, SYSTEM, ASSISTANT)])} AS u2
             FROM (SELECT f.conv_id, f.i, {_row_sql()} FROM it JOIN f ON f.conv_id IS NOT DISTINCT FROM it.conv_id AND f.i = it.i + 1))),
w AS (SELECT u.conv_id, list_min([s0, s3]) AS way FROM it JOIN u ON u.conv_id IS NOT DISTINCT FROM it.conv_id AND it.i = u.rows),
e AS (SELECT conv_id, k, way.a[k] AS e FROM (SELECT conv_id, way, unnest(range(1, length(way.a) + 1)) AS k FROM w)),
g AS (SELECT *, sum((e <> 'I')::INT) OVER o AS row, sum((e <> 'D')::INT) OVER o - 1 AS no, sum((e <> 'D')::INT) OVER (PARTITION BY conv_id) AS lines
      FROM e WINDOW o AS (PARTITION BY conv_id ORDER BY k)),
p AS (SELECT g.conv_id, sha256(string_agg(CASE WHEN e = 'K' THEN f.role WHEN (no - lines % 2) % 2 = 0 THEN 'user' ELSE 'assistant' END
             || ':' || CASE WHEN e = 'I' THEN '' ELSE f.text END, chr(10) ORDER BY k)) AS sha
      FROM g LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM g.conv_id AND f.i = g.row WHERE e <> 'D' GROUP BY g.conv_id)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(way.c, 0) AS cost, coalesce(way.a, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN u ON u.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN w ON w.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN p ON p.conv_id IS NOT DISTINCT FROM a.conv_id
"""
