"""Conversation repair against an enumeration of all edits, a plain search, and odd inputs."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from quern.llm import repair
from quern.llm.queries import QUERIES

PATTERN = re.compile("(s?(ua)+)?")


def enumerated(rows):
    """Least cost and audit of all edit sequences with at most two insertions in a place."""
    best = None
    gap = ["", "u", "a", "uu", "ua", "au", "aa"]
    for inserts in itertools.product(gap, repeat=len(rows) + 1):
        for edits in itertools.product("KDua", repeat=len(rows)):
            roles, audit, cost = inserts[0], "I" * len(inserts[0]), 3 * len(inserts[0])
            for (initial, fault), e, more in zip(rows, edits, inserts[1:]):
                if e != "D" and fault in ("blank", "duplicate"):
                    break
                cost += {"K": 0, "D": 4}.get(e, 3) + (3 if e != "D" and fault == "truncated" else 0) + 3 * len(more)
                roles += {"K": initial, "D": ""}.get(e, e) + more
                audit += {"K": "K", "D": "D"}.get(e, "R") + "I" * len(more)
            else:
                if PATTERN.fullmatch(roles):
                    best = min(best, (cost, audit)) if best else (cost, audit)
    return best


def searched(rows):
    """The same by one heap of whole audits, without a reverse side or blocks; and the roles."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, roles = heapq.heappop(heap)
        if (i, last) in seen:
            continue
        seen.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, audit, roles
        nxt = "a" if last == "u" else "u"
        heapq.heappush(heap, (cost + 3, audit + "I", i, nxt, (*roles, (nxt, None))))
        if i < len(rows):
            initial, fault = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, last, roles))
            if fault not in ("blank", "duplicate"):
                cost += 3 * (fault == "truncated")
                if initial == nxt or (initial == "s" and last == ""):
                    heapq.heappush(heap, (cost, audit + "K", i + 1, initial, (*roles, (initial, i))))
                heapq.heappush(heap, (cost + 3, audit + "R", i + 1, nxt, (*roles, (nxt, i, "R"))))


def random_rows(rng, n):
    return [(rng.choice("ssuuuaaat"), rng.choice(["", "", "", "truncated", "blank", "duplicate"])) for _ in range(n)]


def test_cheapest_edits_of_all():
    rng = random.Random(1)
    for _ in range(60):
        rows = random_rows(rng, rng.randrange(4))
        assert repair.cheapest(rows) == enumerated(rows) == searched(rows)[:2]


def test_cheapest_edits_of_long_conversations():
    rng = random.Random(2)
    for _ in range(300):
        rows = random_rows(rng, rng.randrange(40))
        assert repair.cheapest(rows) == searched(rows)[:2]


def test_joined_blocks_are_the_whole():
    rng = random.Random(3)
    for _ in range(60):
        rows = random_rows(rng, rng.randrange(2, 30))
        cut = sorted(rng.sample(range(1, len(rows)), min(len(rows) - 1, rng.randrange(1, 4))))
        blocks = [rows[a:b] for a, b in zip([0, *cut], [*cut, len(rows)])]
        cells = None
        for block in blocks:
            own = [repair.cheapest(block, s, (t,)) for s in repair.STATES for t in repair.STATES]
            cells = own if cells is None else repair.joined(cells, own)
        found = min(c for c in (cells[s] for s in repair.DONE) if c)
        assert found == repair.cheapest(rows)
        pieces = repair.pieces(found[1], list(map(len, blocks)))
        assert "".join(pieces) == found[1] and [len(p) - p.count("I") for p in pieces] == list(map(len, blocks))


BLANK = " \t\n\x0b\x0c\r"


def slow_conversation(rows):
    """Contract columns of the rows of one conversation, after damage and in order, but for the gaps."""
    marks, seen = [], set()
    for _, role, text in rows:
        last = text.rstrip(BLANK)[-1:]
        fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else ""
        seen.add((role, text))
        marks.append((role[:1], fault))
    cost, audit, roles = searched(marks)
    names = {"u": "user", "a": "assistant"}
    lines = []
    for role in roles:
        if role[1] is None:
            lines.append(names[role[0]] + ":")
        else:
            _, own, text = rows[role[1]]
            lines.append((names[role[0]] if len(role) > 2 else own) + ":" + text)
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marks, marks[1:]))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    counts = [sum(f == name for _, f in marks) for name in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def slow(rows):
    left = {}
    for conv, turn, role, text in rows:
        kept = left.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(name.encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        kept += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{r[1]}\0{r[2]}".encode()).digest())
    return sorted(((c, *slow_conversation(sorted(kept, key=order))) for c, kept in left.items()), key=str)


def contract(spark, rows, tmp_path):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, cost int, audit string")
    df.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    return sorted(map(tuple, QUERIES["op11_conversation_repair"](spark, str(tmp_path)).collect()), key=str)


def test_query(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op11_conversation_repair"](spark, data)
    assert got.columns == "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    assert sorted(map(tuple, got.collect()), key=str) == slow(rows)


def test_odd_rows(spark, tmp_path):
    long = "word " * 50_000 + "end."
    rows = [(1, None, "user", None), (1, None, None, "Null role."), (1, 3, "assistant", "\x0b\t "), (None, 1, "user", "No id."), (None, 2, "assistant", "So."),
            (2, 5, "system", "Be good."), (2, 5, "user", "Same turn!"), (2, 9, "user", long), (2, 9, "user", long), (2, 9, "user", long + "\xa0"),
            (3, 1, "tool", "Result. "), (3, 2, "", "?"), (3, 3, "\U0001f600", "Ends with \U0001f600")]
    rows += [(9, t, "user", "") for t in (None, 4, 4)] + [(c, t, "user", "Hm") for c in range(20, 120) for t in (1,)]
    assert contract(spark, rows, tmp_path) == slow(rows)


def test_empty_table(spark, tmp_path):
    assert contract(spark, [], tmp_path) == []


@pytest.mark.parametrize("bits, piece", [(2, 1), (8, 100), (8, 4 << 20)])
def test_long_conversations_over_many_tasks(spark, tmp_path, monkeypatch, bits, piece):
    monkeypatch.setattr(repair, "BLOCK_BITS", bits)
    monkeypatch.setattr(repair, "PIECE_BYTES", piece)
    rng = random.Random(4)
    texts = ["Yes.", "No", "  ", "Why?", "A longer text that ends.", "And one that does not"]
    rows = []
    for conv, n in ((5, 700), (6, 3), (7, 60), (8, 1)):
        for t in range(n):
            rows.append((conv, t, rng.choice(["system", "user", "user", "assistant", "assistant"]), rng.choice(texts) if rng.random() < 0.3 else f"Text {t}."))
    assert contract(spark, rows, tmp_path) == slow(rows)
