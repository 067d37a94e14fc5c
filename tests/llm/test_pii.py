"""Personal data that no fixed pattern has, planted among look-alikes."""

import random

import pytest
from pyspark.sql import functions as F

from quern.llm import pii

FILLER = (
    "the report was sent to all members of the team before noon and nobody asked for another copy while "
    "we waited in the hall for the train that never came because of snow on the line near the old bridge"
).split()


def luhn(d):
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, d[::-1]))) % 10 == 0


def number(rng, prefix, n, valid):
    while True:
        d = prefix + "".join(rng.choice("0123456789") for _ in range(n - len(prefix)))
        if luhn(d) == valid:
            return d


def grouped(rng, d):
    return rng.choice([d, " ".join(d[i : i + 4] for i in range(0, 16, 4)), "-".join(d[i : i + 4] for i in range(0, 16, 4))])


def planted(rng):
    """A text, and the spans of personal data of the added kinds in it."""
    given, family = rng.choice(pii.GAZETTEERS.given), rng.choice("Miller Schmidt Dubois Garcia Okafor Lindqvist Tanaka Novak".split())
    title = rng.choice(["Mr.", "Mrs.", "Dr.", "Prof.", "Herr", "Frau", "Mme"])
    card = lambda valid: grouped(rng, number(rng, rng.choice(["4", "51", "53", "6011"]), 16, valid))
    area = f"{rng.choice('23456789')}{rng.choice('02345678')}{rng.choice('0123456789')}"
    local = rng.choice([f"({area}) 555-{rng.randrange(10000):04d}", f"{area}-555-{rng.randrange(10000):04d}", f"{area}.555.{rng.randrange(10000):04d}"])
    long = number(rng, rng.choice("0789"), rng.randrange(13, 20), False)
    kind, before, span, after = rng.choice([
        ("account", rng.choice(["charged to credit card ", "my card number is ", "Karte: ", "account ", "pay with visa "]), card(False), rng.choice([" today", ", exp 04/27", ""])),
        ("account", rng.choice(["card no longer works: ", "debit card ", "compte "]), card(False), " please"),
        ("local", rng.choice(["call me at ", "phone: ", "my mobile ", "fax ", "Telefon ", "reach me on "]), local, rng.choice([" after six", "", ", thanks"])),
        ("name", rng.choice(["spoke to ", "dear ", "the patient ", "signed by ", "and then ", "with "]), f"{title} {given} {family}", rng.choice([" yesterday", ",", ""])),
        (None, rng.choice(["order no. ", "tracking ", "isbn ", "serial ", "invoice ", "id=", "part no "]), long, " shipped"),
        (None, "", long, ""),
        (None, rng.choice(["version ", "part no ", "chapter ", "ticket "]), f"{rng.choice('01')}{rng.randrange(100):02d}-{rng.randrange(1000):03d}-{rng.randrange(10000):04d}", ""),
        (None, rng.choice(["the film starring ", "a novel on ", "played by ", "said "]), f"{rng.choice(['Mr.', 'Dr.', 'Prof.', 'Frau'])} {rng.choice(pii.GAZETTEERS.offices)}", " again"),
        (None, "charged to credit card ", card(True), " today"),
        (None, "mail ", f"{given.lower().encode('ascii', 'ignore').decode()}@example.com", ""),
        (None, "call ", f"+1 {local}", ""),
    ])
    if rng.random() < 0.15:  # cues are missing, or mislead
        before = rng.choice(["", "and then ", "in the hall "]) if kind else rng.choice(["a card with ", "on the phone ", "dear reader, "])
    words = [rng.choice(FILLER) for _ in range(rng.randrange(14, 40))]
    at = rng.randrange(1, len(words))
    head = " ".join(words[:at]) + rng.choice([" ", ".\n"]) + before
    return head + span + after + " " + " ".join(words[at:]), [(kind, len(head), len(head) + len(span))] if kind else []


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(11)
    learn, test = ([planted(rng) for _ in range(3000)] for _ in range(2))
    schema = "id int, text string"
    model = pii.train(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(learn)], schema))
    rows = pii.with_spans(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(test)], schema), model).collect()
    found = {(r.id, s.kind, s.start, s.end) for r in rows for s in r.pii if s.kind in pii.ADDED}
    truth = {(i, *s) for i, (_, spans) in enumerate(test) for s in spans}
    return model, found, truth, test


@pytest.mark.parametrize("kind", pii.ADDED)
def test_added_kinds_are_found_among_look_alikes(judged, kind):
    _, found, truth, test = judged
    found, truth = ({s for s in x if s[1] == kind} for x in (found, truth))
    right = len(found & truth)
    print(kind, "precision", round(right / len(found), 3), "recall", round(right / len(truth), 3), "of", len(truth))
    assert right >= 0.9 * len(found) and right >= 0.9 * len(truth) > 50


def test_reliabilities_are_learned(judged):
    rate = judged[0].reliability
    for labeler, sort in (("cue", "number"), ("issuer", "number"), ("cue", "telephone"), ("given", "name")):
        other, personal = rate[labeler][sort]
        assert personal[2] > other[2] and personal[0] < other[0]


def test_votes_do_not_ask_for_the_kind(spark):
    """A candidate of another kind of the same sort gets the same votes."""
    rows = [("card", "4111 1111 1111 1111", "my card ", " ok"), ("phone", "222-555-1234", "call ", ""), ("name", "Dr. Anna Miller", "with ", "")]
    df = spark.createDataFrame(rows, "kind string, value string, left string, right string")
    twin = df.withColumn("kind", F.when(F.col("kind") == "card", "account").when(F.col("kind") == "phone", "local").otherwise(F.col("kind")))
    votes = [d.select(*[v.alias(n) for n, v in pii.labelers(F.struct("*")).items()]).collect() for d in (df, twin)]
    assert votes[0] == votes[1]
    assert votes[0][0].issuer == votes[0][0].check == votes[0][0].cue == 1 and votes[0][1].area == votes[0][1].cue == 1 and votes[0][2].given == 1


def test_other_gazetteers(spark):
    tables = pii.Gazetteers(given=("Zorblax",), offices=("Anna",))
    texts = [f"with Dr. Zorblax Quux dear {i}" for i in range(40)] + [f"the film starring Dr. Anna Quux {i}" for i in range(40)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    found = {r.text: len(r.pii) for r in pii.with_spans(df, pii.train(df, tables=tables)).collect()}
    assert all(n == ("Zorblax" in t) for t, n in found.items())
