"""Text clean-up and tokenising as Column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# Default English stop words.
STOP_WORDS = (
    "a about above after again against all am an and any are as at be because been "
    "before being below between both but by can did do does doing don down during each "
    "few for from further had has have having he her here hers herself him himself his "
    "how i if in into is it its itself just me more most my myself no nor not now of off "
    "on once only or other our ours ourselves out over own s same she should so some such "
    "t than that the their theirs them themselves then there these they this those through "
    "to too under until up very was we were what when where which while who whom why will "
    "with you your yours yourself yourselves"
).split()


def remove_punctuation(c: Column) -> Column:
    """Lower-case, keep ASCII letters, digits and spaces, trim."""
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9 ]", ""))


def split_words(c: Column) -> Column:
    """Split on single spaces; runs of spaces leave empty strings."""
    return F.split(c, " ", -1)


def simple_tokenize(c: Column) -> Column:
    """Lower-cased runs of ASCII word characters (``_`` included), duplicates kept."""
    return F.array_remove(F.split(F.lower(c), r"\W+", -1), "")


def tokenize(c: Column, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """``simple_tokenize`` without stop words, duplicates of other tokens kept.

    The list becomes an ``IN`` set in the plan, so it suits lists of some hundreds;
    longer lists go through ``operators.text.drop_stop_words``.
    """
    stop = list(stop_words)
    tokens = simple_tokenize(c)
    return F.filter(tokens, lambda t: ~t.isin(stop)) if stop else tokens


def match_any(c: Column, patterns: Iterable[str]) -> Column:
    """The patterns that occur in a text, in the given order (Java regex, lookbehind allowed)."""
    hits = [F.when(c.rlike(p), F.lit(p)) for p in patterns]
    return F.array_compact(F.array(*hits))


def remove_quotes(c: Column) -> Column:
    return F.translate(c, '"', "")


def key_value_line(key: Column, value: Column) -> Column:
    """``key: value`` for reports."""
    return F.concat(key.cast("string"), F.lit(": "), value.cast("string"))


def pair_key(*parts: Column) -> Column:
    """Parts joined by one blank, the key form of matched records."""
    return F.concat_ws(" ", *[p.cast("string") for p in parts])
