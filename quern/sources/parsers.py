"""Line formats: each parser adds typed columns and a ``status`` and keeps the raw line.

``status`` is 1 for a parsed line, 0 for a line set aside (a header, or an unreadable
line where the format has no header) and -1 for a bad line of a format with a header or
of numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quern.functions.text import pair_key, remove_quotes
from quern.functions.times import dash_to_zero, parse_apache_time
from quern.functions.vectors import bind

# Line patterns. ``(?d)`` makes the dot stop at line feeds only.
CLF_PATTERN = r'^(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+)\s*(\S*)" (\d{3}) (\S+)'
CLF_PATTERN_SPACED_ENDPOINT = (
    r'^(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+) ([^"\n]*?)\s*(HTTP/\S*|)" (\d{3}) (\S+)'
)
USER_AGENT_PATTERN = r"^(\S+) \(([^(]*)\) (\S+) \(([^(]*)\) (\S+) (\S+)"
PRODUCT_PATTERN = r'(?d)^(.+),"(.+)",(.*),(.*),(.*)'
PAIR_PATTERN = r"(?d)^(.+),(.+)"

# Names of the fields.
CLF_FIELDS = (
    "host", "client_identd", "user_id", "date_time", "method", "endpoint", "protocol", "response_code", "content_size",
)
USER_AGENT_FIELDS = (
    "browser_compatibility", "os_ver", "platform", "browser_platform_details", "enhancement_1", "enhancement_2",
)

_MARK = "\ue000"


def _once(value: Column) -> Column:
    """``value`` as a generated column.

    Filters on parsed fields would otherwise be pushed below the projection with a copy
    of the regular expression for every use.
    """
    return F.explode(F.array(value))


def parse_clf(lines: DataFrame, col: str = "value", spaced_endpoints: bool = False) -> DataFrame:
    """Common Log Format lines to ``raw, status`` and nine typed fields.

    The pattern runs once per line: it rewrites the line to its groups on separate lines,
    which no group can contain. ``spaced_endpoints`` also accepts blanks in the endpoint.
    """
    pattern = CLF_PATTERN_SPACED_ENDPOINT if spaced_endpoints else CLF_PATTERN
    groups = "\n".join(f"${i}" for i in range(1, len(CLF_FIELDS) + 1))
    rewritten = F.regexp_replace(F.col(col), pattern + r"[\s\S]*", groups)
    parts = lines.select(F.col(col).alias("raw"), _once(F.split(rewritten, "\n", -1)).alias("_p"))
    matched = F.size("_p") == len(CLF_FIELDS)

    def part(i: int) -> Column:
        return F.when(matched, F.col("_p")[i])

    typed = {
        "date_time": parse_apache_time(part(3)),
        "response_code": part(7).try_cast("int"),
        "content_size": dash_to_zero(part(8)),
    }
    fields = parts.select(
        "raw", *[typed.get(name, part(i)).alias(name) for i, name in enumerate(CLF_FIELDS)]
    )
    good = F.col("date_time").isNotNull() & F.col("response_code").isNotNull() & F.col("content_size").isNotNull()
    return fields.select("raw", good.cast("int").alias("status"), *CLF_FIELDS)


def split_valid_invalid(parsed: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Good rows, bad raw lines, and one row ``read, parsed, failed`` counted in one pass.

    A header (status 0 in a format that marks bad lines with -1) counts as read only,
    so ``failed`` takes the lowest status the parser gives.
    """
    valid = parsed.filter("status = 1").drop("raw", "status")
    bad_status = F.lit(-1) if "header" in parsed.columns else F.lit(0)
    invalid = parsed.filter(F.col("status") == bad_status).select("raw")
    counts = parsed.agg(
        F.count("*").alias("read"),
        F.count_if(F.col("status") == 1).alias("parsed"),
        F.count_if(F.col("status") == bad_status).alias("failed"),
    )
    return valid, invalid, counts


def _groups(line: Column, pattern: str, n: int) -> Column:
    """The groups of a pattern that matches once in a line, by one rewrite; null where it does not match.

    Marks around the groups are private characters; a line that has such a character itself
    gives its groups one by one.
    """
    found = "".join(f"{_MARK}${i}" for i in range(1, n + 1)) + _MARK
    parts = F.split(F.regexp_replace(line, pattern, found), _MARK, -1)
    marked = bind(parts, lambda p: F.when(F.size(p) == n + 2, F.slice(p, 2, n)))
    single = F.when(line.rlike(pattern), F.array(*[F.regexp_extract(line, pattern, i) for i in range(1, n + 1)]))
    return F.when(F.contains(line, F.lit(_MARK)), single).otherwise(marked)


def parse_user_agent(df: DataFrame, col: str) -> DataFrame:
    """Adds the six parts of a user agent and ``parse_ok``; parts are null where it fails."""
    parsed = df.select("*", _once(_groups(F.col(col), USER_AGENT_PATTERN, len(USER_AGENT_FIELDS))).alias("_u"))
    parts = [F.get("_u", F.lit(i)).alias(name) for i, name in enumerate(USER_AGENT_FIELDS)]
    return parsed.select(*df.columns, *parts, F.col("_u").isNotNull().alias("parse_ok"))


def _status_with_header(groups: Column, header_key: str) -> Column:
    return F.when(groups.isNull(), -1).when(groups[0] == header_key, 0).otherwise(1)


def parse_quoted_product(lines: DataFrame, col: str = "value", header_key: str = '"id"') -> DataFrame:
    """Catalogue lines to ``id`` and ``product`` (name, description and maker joined)."""
    line = F.col(col)
    parts = lines.select(line.alias("raw"), _once(_groups(line, PRODUCT_PATTERN, 4)).alias("_g"))
    g = F.col("_g")
    status = _status_with_header(g, header_key)
    return parts.select(
        "raw",
        status.alias("status"),
        (status == 0).alias("header"),
        F.when(status == 1, remove_quotes(g[0])).alias("id"),
        F.when(status == 1, pair_key(g[1], g[2], g[3])).alias("product"),
    )


def parse_gold_mapping(lines: DataFrame, header_key: str, col: str = "value") -> DataFrame:
    """Lines ``a,b`` to ``id_a``, ``id_b`` and the joint key ``"a b"``."""
    line = F.col(col)
    parts = lines.select(line.alias("raw"), _once(_groups(line, PAIR_PATTERN, 2)).alias("_g"))
    status = _status_with_header(F.col("_g"), header_key)
    first, second = remove_quotes(F.col("_g")[0]), remove_quotes(F.col("_g")[1])
    return parts.select(
        "raw",
        status.alias("status"),
        (status == 0).alias("header"),
        F.when(status == 1, first).alias("id_a"),
        F.when(status == 1, second).alias("id_b"),
        F.when(status == 1, pair_key(first, second)).alias("pair"),
    )


def _checked(lines: DataFrame, col: str, parts: Column, ok, fields, keep: list[str] | None = None) -> DataFrame:
    """``raw``, ``status`` (1, or -1 for a line that does not fit) and typed fields, null unless status is 1.

    ``ok`` and ``fields`` are functions of the parts, which are computed once.
    """
    kept = keep or []
    split = lines.select(*kept, F.col(col).alias("raw"), _once(parts).alias("_f"))
    fits = F.coalesce(ok(F.col("_f")), F.lit(False))
    status = F.when(fits, 1).otherwise(-1)
    typed = fields(F.col("_f"))
    return split.select(
        *kept, "raw", status.alias("status"), *[F.when(status == 1, c).alias(name) for name, c in typed.items()]
    )


def _part(parts: Column, i: int, kind: str) -> Column:
    return F.get(parts, F.lit(i)).try_cast(kind)


def parse_ratings(lines: DataFrame, col: str = "value") -> DataFrame:
    """``user::item::rating::time`` to ``raw, status`` and typed ``user, item, rating``."""
    def fields(f: Column) -> dict[str, Column]:
        return {"user": _part(f, 0, "bigint"), "item": _part(f, 1, "bigint"), "rating": _part(f, 2, "double")}

    def ok(f: Column) -> Column:
        return F.forall(F.array(*[c.isNotNull() for c in fields(f).values()]), lambda x: x)

    return _checked(lines, col, F.split(F.col(col), "::", -1), ok, fields)


def parse_movies(lines: DataFrame, col: str = "value") -> DataFrame:
    """``item::title::genres`` to ``raw, status`` and ``item, title``."""
    return _checked(
        lines, col, F.split(F.col(col), "::", -1),
        lambda f: _part(f, 0, "bigint").isNotNull() & F.get(f, F.lit(1)).isNotNull(),
        lambda f: {"item": _part(f, 0, "bigint"), "title": F.get(f, F.lit(1))},
    )


def _numbers(parts: Column) -> Column:
    return F.transform(parts, lambda x: x.try_cast("double"))


def _all_numbers(numbers: Column) -> Column:
    return F.forall(numbers, lambda x: x.isNotNull())


def parse_labeled_csv(lines: DataFrame, col: str = "value") -> DataFrame:
    """Comma separated numbers: ``raw, status``, the first is the ``label``, the rest ``features``."""
    return _checked(
        lines, col, _numbers(F.split(F.col(col), ",", -1)), _all_numbers,
        lambda n: {"label": F.get(n, F.lit(0)), "features": F.slice(n, 2, F.greatest(F.size(n) - 1, F.lit(0)))},
    )


def parse_ctr(lines: DataFrame, col: str = "value", separator: str = "[\t,]") -> DataFrame:
    """``raw, status``, label, then categories; ``features`` holds (feature, value) with features from 0.

    An empty value is a category of its own. Other columns of ``lines`` are kept.
    """
    def fields(f: Column) -> dict[str, Column]:
        categories = F.slice(f, 2, F.greatest(F.size(f) - 1, F.lit(0)))
        listed = F.transform(categories, lambda v, i: F.struct(i.alias("feature"), v.alias("value")))
        return {"label": _part(f, 0, "double"), "features": listed}

    keep = [c for c in lines.columns if c not in (col, "raw", "status", "label", "features")]
    return _checked(
        lines, col, F.split(F.col(col), separator, -1), lambda f: _part(f, 0, "double").isNotNull(), fields, keep
    )


def parse_series(lines: DataFrame, col: str = "value") -> DataFrame:
    """Blank separated numbers: ``raw, status``, then ``x``, ``y`` and the series ``ts``."""
    def fields(f: Column) -> dict[str, Column]:
        rest = F.slice(f, 3, F.greatest(F.size(f) - 2, F.lit(0)))
        return {"x": _part(f, 0, "bigint"), "y": _part(f, 1, "bigint"), "ts": _numbers(rest)}

    def ok(f: Column) -> Column:
        typed = fields(f)
        return typed["x"].isNotNull() & typed["y"].isNotNull() & _all_numbers(typed["ts"])

    return _checked(lines, col, F.split(F.trim(F.col(col)), r"\s+", -1), ok, fields)
