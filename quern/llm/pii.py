"""Personal data by weak supervision: regex, gazetteer and context labelers vote on spans.

Candidates of one sort (long numbers, telephone numbers, addresses, names) are judged alike,
whether a fixed pattern has them or not. Expectation-maximisation estimates how reliable
each labeler is and how likely each pattern of votes is personal data; a logistic span
classifier is then fitted to those probabilities. The spans of the fixed patterns always
stay, the classifier adds others: account numbers without a valid check digit, telephone
numbers without a plus sign, and names after a form of address. Column expressions only; the
driver sees counts of vote patterns and of feature patterns, whose number does not depend on
the data.

Defined results: a null or empty text has no spans; repeated rows are judged each on their
own; an empty table gives no rows, and a model without candidates adds no spans; other
columns are kept, only the output column replaces one of its name.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from quern.llm.common import documents, let, once, span_digest, span_text

BASE = ("email", "ip", "card", "phone")
ADDED = ("account", "local", "name")
KINDS = BASE + ADDED

# Possessive quantifiers and look-behinds change no match; they keep long runs linear.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
DIGITS = r"(?<![0-9])[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
LOCAL = r"(?<![0-9+.-])(?:\([0-9]{2,4}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])"
# Forms of address.
NAME = r"(?<!\p{L})(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Monsieur|Madame|Señor|Señora)\.?\x20\p{Lu}\p{Ll}+(?:\x20\p{Lu}\p{Ll}+)?"

#: What the candidates of a kind are told apart by: kinds of one sort are judged alike.
SORTS = {"email": "email", "ip": "ip", "card": "number", "account": "number", "phone": "telephone", "local": "telephone", "name": "name"}

_MARK, _OTHER = "", ""  # private use: the second stands in for the first, same length
LEFT, RIGHT = 40, 20  # characters of context
_BLOCK = 256

CUES = {
    "email": "mail|contact|write to|kontakt|correo|courriel",
    "ip": r"\bip\b|address|host|server|client|adresse",
    "number": r"card|visa|mastercard|amex|credit|debit|account|iban|karte|konto|carte|compte|tarjeta|cuenta|\bcvv\b|\bacct",
    "telephone": r"phone|\btel|\bcall|\bfax|mobile|\bcell|reach (?:me|us)|telefon|téléphone|teléfono|anrufen",
    "name": r"name|patient|customer|signed|sincerely|regards|dear|spoke (?:to|with)|contact|liebe|cher|estimad",
}
#: Words that point to numbers and names of another kind.
OTHERS = r"version|isbn|issn|order|invoice|tracking|serial|part no|ticket|page|chapter|figure|total|\bv$|\bno\.? $|# ?$|starring|played by|film|novel"


@dataclass(frozen=True)
class Gazetteers:
    """Tables the labelers look things up in; give others for other languages or markets."""

    #: First four digits, from and to, and lengths of the card numbers of an issuer.
    issuers: tuple[tuple[int, int, tuple[int, ...]], ...] = (
        (3400, 3499, (15,)), (3700, 3799, (15,)), (3528, 3589, (16,)), (3600, 3699, (14,)), (4000, 4999, (13, 16, 19)),
        (5100, 5599, (16,)), (6011, 6011, (16,)), (6221, 6229, (16, 17, 18, 19)), (6500, 6599, (16,)), (2221, 2720, (16,)),
    )
    domains: tuple[str, ...] = tuple("com org net edu gov io info de fr es it uk eu ch at us".split())
    given: tuple[str, ...] = tuple(
        "Anna Maria Thomas Michael Peter Julia Laura Sarah Daniel David Paul Martin Andreas Stefan Christian Sabine Claudia "
        "Monika Ursula Hans Klaus Jürgen James John Robert William Mary Patricia Jennifer Linda Elizabeth Susan Jessica Karen "
        "Jane Emily Emma Olivia Jack Harry George Charles Richard Joseph Mark Steven Kevin Brian Jean Pierre Michel Marie "
        "Sophie Camille Claire Nicolas Julien Antoine Luc Louis José Juan Carlos Luis Miguel Javier Carmen Isabel Ana Lucía "
        "Elena Pablo Sofía Manuel Rosa".split()
    )
    offices: tuple[str, ...] = tuple(
        "President Speaker Chairman Chairwoman Secretary Minister Ambassador Justice Judge General Who Doctor Holle Right "
        "Perfect Robot Universe Pepper Watson Strange Freeze Bean Potato Clean Monopoly".split()
    )


GAZETTEERS = Gazetteers()


def _positions(lengths: Column) -> Column:
    """Running sums of a list, by blocks, so that a long list is not copied once per element."""

    def sums(xs: Column) -> Column:
        start = F.struct(F.array().cast("array<int>").alias("out"), F.lit(0).alias("sum"))
        return F.aggregate(
            xs,
            start,
            lambda s, x: F.struct(F.array_append(s["out"], s["sum"] + x).alias("out"), (s["sum"] + x).alias("sum")),
            lambda s: s["out"],
        )

    count = F.ceil(F.size(lengths) / _BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), count - 1), lambda b: sums(F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK))))

    def joined(bs: Column) -> Column:
        def shifted(before: Column) -> Column:
            return F.flatten(
                F.transform(bs, lambda b, i: F.transform(b, lambda x: x + F.coalesce(F.get(before, i - 1), F.lit(0))))
            )

        return let(sums(F.transform(bs, lambda b: F.element_at(b, -1))), shifted)

    return let(blocks, joined)


_FOUND = "array<struct<start:int,end:int,value:string,left:string,right:string>>"


def matches(text: Column, pattern: str, maybe: Column) -> Column:
    """Leftmost non-overlapping matches with their places and context; ``maybe`` is a cheap test first."""
    marked = F.regexp_replace(F.translate(text, _MARK, _OTHER), f"({pattern})", f"{_MARK}$1{_MARK}")

    def located(pieces: Column) -> Column:
        def of(ends: Column) -> Column:
            return F.transform(
                F.sequence(F.lit(1), F.size(pieces) - 1, F.lit(2)),
                lambda i: F.struct(
                    F.get(ends, i - 1).alias("start"),
                    F.get(ends, i).alias("end"),
                    F.get(pieces, i).alias("value"),
                    F.right(F.get(pieces, i - 1), F.lit(LEFT)).alias("left"),
                    F.left(F.get(pieces, i + 1), F.lit(RIGHT)).alias("right"),
                ),
            )

        return F.when(F.size(pieces) > 1, let(_positions(F.transform(pieces, F.length)), of)).otherwise(
            F.array().cast(_FOUND)
        )

    return F.when(maybe, let(F.split(marked, _MARK, -1), located)).otherwise(F.array().cast(_FOUND))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits has a valid check digit."""

    def doubled(i: Column) -> Column:
        d = F.substring(number, -i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    places = F.transform(F.sequence(F.lit(1), F.length(number)), doubled)
    return F.aggregate(places, F.lit(0), lambda s, x: s + x) % 10 == 0


def _as(kind: str, found: Column) -> Column:
    return F.transform(
        found,
        lambda c: F.struct(
            F.lit(kind).alias("kind"), c["start"].alias("start"), c["end"].alias("end"),
            c["value"].alias("value"), c["left"].alias("left"), c["right"].alias("right"),
        ),
    )


def candidates(text: Column) -> Column:
    """Spans of all kinds, by kind and then start; those of added kinds overlap no base span."""
    digit = text.rlike("[0-9]")
    part = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    email = matches(text, EMAIL, F.contains(text, F.lit("@")))
    ip = F.filter(matches(text, IP, digit), lambda c: c["value"].rlike(rf"^{part}(?:\.{part}){{3}}$"))
    long = F.filter(matches(text, DIGITS, digit), lambda c: F.length(digits(c["value"])).between(13, 19))
    phone = F.filter(
        matches(text, PHONE, F.contains(text, F.lit("+"))), lambda c: F.length(digits(c["value"])).between(9, 15)
    )
    local = matches(text, LOCAL, digit)
    name = matches(text, NAME, F.lit(True))

    def with_base(numbers: Column) -> Column:
        valid = F.filter(numbers, lambda c: luhn(digits(c["value"])))
        base = F.concat(_as("email", email), _as("ip", ip), _as("card", valid), _as("phone", phone))
        more = F.concat(
            _as("account", F.filter(numbers, lambda c: ~luhn(digits(c["value"])))), _as("local", local), _as("name", name)
        )

        def both(b: Column) -> Column:
            clear = F.filter(more, lambda c: ~F.exists(b, lambda x: (x["start"] < c["end"]) & (c["start"] < x["end"])))
            return F.concat(b, clear)

        return let(base, both)

    return let(long, with_base)


def _vote(yes: Column, no: Column | None = None) -> Column:
    """1 for, -1 against, 0 without an opinion."""
    vote = F.when(yes, F.lit(1))
    return vote.otherwise(0) if no is None else vote.when(no, F.lit(-1)).otherwise(0)


def _sort(c: Column) -> Column:
    found = F.lit("number")
    for kind, sort in SORTS.items():
        if sort != "number":
            found = F.when(c["kind"] == kind, sort).otherwise(found)
    return found


def labelers(c: Column, tables: Gazetteers = GAZETTEERS) -> dict[str, Column]:
    """One vote each on a candidate, by its characters and what is around it; none asks for its kind."""
    value, sort = c["value"], _sort(c)
    left, right = F.lower(c["left"]), F.lower(c["right"])
    number = digits(value)
    # context of the same line and the one before: a cue counts up to the line before the last
    cued = F.lit(False)
    for s, cue in CUES.items():
        cued = cued | ((sort == s) & (left.rlike(cue) | right.rlike(cue)))
    head = F.substring(number, 1, 4).try_cast("int")
    issued = F.lit(False)
    for low, high, lengths in tables.issuers:
        issued = issued | (head.between(low, high) & F.length(number).isin(*lengths))
    one_digit = number.rlike(r"^([0-9])\1*$") | F.lit("01234567890123456789").contains(number)
    area = F.regexp_extract(value, r"([0-9]{3})[^0-9]*[0-9]{3}[^0-9]*[0-9]{4}$", 1)
    words = F.split(value, r"\.?\x20")
    return {
        # regex labelers
        "check": _vote(F.when(number == "", F.lit(False)).otherwise(luhn(number)), number != ""),
        "grouped": _vote(
            value.rlike(r"^[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}$|^[0-9]{4}([ -])[0-9]{6}\2[0-9]{5}$|^(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\) ?|[0-9]{3}([.-]))[0-9]{3}(?:\3|-)[0-9]{4}$"),
            value.rlike("[ -][0-9]{1,2}[ -]|^[0-9]{1,2}[ -]"),
        ),
        "shape": _vote(F.lit(False), (number != "") & (one_digit | number.startswith("0000"))),
        # gazetteer labelers: issuers of cards, area codes, top-level domains, networks that name no one, given names
        "issuer": _vote(issued, F.lit(True)),
        "area": _vote(area.rlike("^[2-9]") & ~area.rlike("^.11"), (area != "") | value.startswith("0")),
        "domain": _vote(F.element_at(F.split(F.lower(value), r"\."), -1).isin(*tables.domains)),
        "network": _vote(F.lit(False), value.rlike(r"^(?:0|127|255|10|192\.168)\.")),
        "given": _vote(F.get(words, F.lit(1)).isin(*tables.given), F.exists(words, lambda w: w.isin(*tables.offices))),
        "two_names": _vote(F.size(words) == 3),
        # context labelers
        "cue": _vote(cued, left.rlike(OTHERS)),
        "colon": _vote(left.rlike(r"[:(<] ?$"), left.rlike(r"[=/#] ?$")),
        "company": _vote(left.rlike(r"@[a-z0-9-]+\.|\+[0-9][ ().0-9-]{8}") | right.rlike(r"@|\+[0-9]")),
        "joined": _vote(F.lit(False), left.rlike(r"[\p{L}0-9_/=-]$") | right.rlike(r"^[\p{L}0-9_/=-]")),
    }


#: Sorts that a labeler judges; for others it has neither a vote nor an abstention.
JUDGES = {
    "check": ("number",),
    "grouped": ("number", "telephone"),
    "shape": ("number", "telephone"),
    "issuer": ("number",),
    "area": ("telephone",),
    "domain": ("email",),
    "network": ("ip",),
    "given": ("name",),
    "two_names": ("name",),
}


def judged_votes(c: Column, tables: Gazetteers = GAZETTEERS) -> dict[str, Column]:
    """The votes, 0 where a labeler does not judge the candidate's sort."""
    sort = _sort(c)
    return {
        n: F.when(sort.isin(*JUDGES[n]), v).otherwise(0) if n in JUDGES else v for n, v in labelers(c, tables).items()
    }


def features(c: Column, tables: Gazetteers = GAZETTEERS) -> dict[str, Column]:
    """What the span classifier sees, each 0 or 1; their patterns are few, whatever the data."""
    sort = _sort(c)
    seen = {f"is_{s}": sort == s for s in dict.fromkeys(SORTS.values())}
    for name, vote in judged_votes(c, tables).items():
        seen[f"{name}_for"], seen[f"{name}_against"] = vote == 1, vote == -1
    seen["starts_line"] = c["left"].rlike(r"(?:^|\n)$")
    return {n: v.cast("int") for n, v in seen.items()}


@dataclass(frozen=True)
class Model:
    """Weights of the span classifier and the estimated labelers: P(vote | class) by name and sort."""

    weights: dict[str, float]
    bias: float = 0.0
    reliability: dict[str, dict[str, list[list[float]]]] = field(default_factory=dict)
    tables: Gazetteers = GAZETTEERS

    def probability(self, c: Column) -> Column:
        score = F.lit(self.bias)
        for name, value in features(c, self.tables).items():
            if name in self.weights:
                score = score + self.weights[name] * value
        return 1 / (1 + F.exp(-score))


def _counted(found: DataFrame, columns: dict[str, Column]) -> list[Row]:
    named = found.select(*[v.alias(n) for n, v in columns.items()])
    return named.groupBy(*columns).agg(F.count("*").alias("n")).collect()


#: What votes count where estimation starts, if not 1: a number that fails its check digit needs more than a prefix.
START = {"check": 2.0, "cue": 2.0, "joined": 2.0}
#: Shares of votes -1, 0, 1 that a labeler is believed to give on other spans and on personal data, and how much that
#: weighs: as a number of candidates, and as a share of them. One random number in ten passes the check digit.
BELIEF = ((0.5, 1 / 3, 1 / 6), (1 / 6, 1 / 3, 0.5), 6, 0.0)
BELIEFS = {"check": ((0.9, 0.0, 0.1), (0.05, 0.0, 0.95), 6, 0.5)}


def estimate(
    votes: np.ndarray, judged: np.ndarray, sorts: Sequence[str], counts: np.ndarray, names: Sequence[str], rounds: int = 200
):
    """Probability of each vote pattern, and P(vote | class) of each labeler for each sort, by EM.

    Votes are taken as independent given the class and the sort; a sort has its own prior. It
    starts from the sum of votes and from the belief that a labeler's votes are right rather
    than wrong.
    """
    n, m = votes.shape
    start = np.array([START.get(name, 1.0) for name in names])
    p = 1 / (1 + np.exp(-1.2 * (np.where(judged, votes, 0) * start).sum(1)))
    rate = np.ones((2, len(sorts), m, 3)) / 3
    for _ in range(rounds):
        odds = np.zeros(n)
        for sort in set(sorts):
            own = np.array([s == sort for s in sorts])
            weight = counts[own] * np.stack([1 - p[own], p[own]])
            share = (weight[1].sum() + 2) / (weight.sum() + 4)
            odds[own] = math.log(share) - math.log(1 - share)
            for j in np.flatnonzero(judged[own].any(0)):
                other, personal, fixed, part = BELIEFS.get(names[j], BELIEF)
                seen = np.array([other, personal]) * (fixed + part * weight.sum()) + 1e-3
                seen += np.stack([[w[votes[own, j] == v].sum() for v in (-1, 0, 1)] for w in weight])
                seen /= seen.sum(1, keepdims=True)
                rate[:, own, j] = seen[:, None]
                odds[own] += np.log(seen[1] / seen[0])[votes[own, j] + 1]
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(new - p).max() < 1e-6:
            break
        p = new
    return p, rate


def fit_logistic(x: np.ndarray, y: np.ndarray, counts: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Newton's method on weighted patterns with fractional labels."""
    a = np.column_stack([x, np.ones(len(x))]).astype(float)
    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ ((y - p) * counts) - ridge * w
        hessian = (a * (p * (1 - p) * counts)[:, None]).T @ a + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], w[-1]


def train(docs: DataFrame, text: str = "text", tables: Gazetteers = GAZETTEERS) -> Model:
    """Counts vote and feature patterns over all texts, estimates labelers, fits the classifier."""
    listed = docs.select(candidates(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("c"))
    found = listed.select(F.explode_outer("c").alias("c")).filter("c is not null")
    seen = features(F.col("c"), tables)
    rows = _counted(found, {"sort": _sort(F.col("c")), **seen})
    if not rows:
        return Model({}, -30.0, tables=tables)
    names = [f.removesuffix("_for") for f in seen if f.endswith("_for")]
    votes = np.array([[r[f"{n}_for"] - r[f"{n}_against"] for n in names] for r in rows])
    counts = np.array([r.n for r in rows], float)
    sorts = [r.sort for r in rows]
    judged = np.array([[s in JUDGES.get(n, (s,)) for n in names] for s in sorts])
    p, rate = estimate(votes, judged, sorts, counts, names)
    x = np.array([[r[f] for f in seen] for r in rows])
    weights, bias = fit_logistic(x, p, counts)
    reliability = {
        n: {s: rate[:, sorts.index(s), j].tolist() for s in sorted(set(sorts)) if s in JUDGES.get(n, (s,))} for j, n in enumerate(names)
    }
    return Model(dict(zip(seen, map(float, weights))), float(bias), reliability, tables)


def with_spans(docs: DataFrame, model: Model, text: str = "text", out: str = "pii", least: float = 0.5) -> DataFrame:
    """Adds ``out``: spans ``kind, start, end`` by kind, then start; code points, ends exclusive."""
    listed = candidates(F.coalesce(F.col(f"`{text}`"), F.lit("")))

    def stays(c: Column) -> Column:
        return c["kind"].isin(*BASE) | (model.probability(c) >= least)

    spans = F.transform(
        F.filter(listed, stays),
        lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")),
    )
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() != out.lower()]
    return docs.select(*kept, once(spans).alias(out))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    spans = F.col("pii")
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")

    return with_spans(docs, train(docs)).select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS],
        span_digest(base).alias("base_sha256"),
        span_text(spans).alias("spans"),
    )
