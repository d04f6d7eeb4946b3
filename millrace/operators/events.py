"""An append-only event log: listing, latest, superseding, current state and token search."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StringType

EVENT = (
    "event_id string, user_id string, event_type string, timestamp timestamp, payload_json string, source string, "
    "confidence double, conversation_id string, tags array<string>"
)


def listing(
    events: DataFrame,
    user=None,
    types: list[str] | None = None,
    since=None,
    until=None,
    limit: int | None = None,
    ts: str = "timestamp",
) -> DataFrame:
    """Newest first, ties by the larger identifier; both time bounds belong to the range."""
    df = events
    if user is not None:
        df = df.filter(F.col("user_id") == F.lit(user))
    if types:
        df = df.filter(F.col("event_type").isin(types))
    if since is not None:
        df = df.filter(F.col(ts) >= F.lit(since))
    if until is not None:
        df = df.filter(F.col(ts) <= F.lit(until))
    df = df.orderBy(F.desc(ts), F.desc("event_id"))
    return df.limit(limit) if limit is not None else df


def latest(events: DataFrame, by: list[str], ts: str = "timestamp") -> DataFrame:
    """The newest event of each group; superseded ones count. An aggregate, so a hot group is combined early."""
    rest = [c for c in events.columns if c not in by]
    out = events.groupBy(*by).agg(F.max_by(F.struct(*rest), F.struct(ts, "event_id")).alias("r"))
    return out.select(*by, "r.*").select(*events.columns)


def append(log: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of ``batch`` to add: blank identifiers get a new one, an identifier twice or in the log is an error."""
    ident = F.when(F.coalesce(F.col("event_id").cast("string"), F.lit("")) == "", F.uuid()).otherwise(F.col("event_id").cast("string"))
    new = batch.withColumn("event_id", ident)
    w = Window.partitionBy("event_id")
    known = log.select(F.col("event_id").cast("string").alias("event_id")).distinct().withColumn("__old", F.lit(True))
    new = new.withColumn("__n", F.count(F.lit(1)).over(w)).join(known, "event_id", "left")
    clash = (F.col("__n") > 1) | F.col("__old").isNotNull()
    checked = F.when(clash, F.raise_error(F.concat(F.lit("duplicate event_id "), F.col("event_id")))).otherwise(F.col("event_id"))
    return new.withColumn("event_id", checked).drop("__n", "__old").select(*batch.columns)


def with_superseded(events: DataFrame, supersessions: DataFrame) -> DataFrame:
    """``superseded_by`` from an append-only table of (event_id, superseded_by, at): the newest entry counts."""
    last = supersessions.groupBy("event_id").agg(F.max_by("superseded_by", F.struct("at", "superseded_by")).alias("superseded_by"))
    return events.drop("superseded_by").join(last, "event_id", "left")


def chain(events: DataFrame, by: list[str], ts: str = "timestamp") -> DataFrame:
    """``superseded_by``: the next event of the group."""
    w = Window.partitionBy(*by).orderBy(ts, "event_id")
    return events.withColumn("superseded_by", F.lead("event_id").over(w))


def current_state(events: DataFrame, by: list[str], ts: str = "timestamp") -> DataFrame:
    """Extension: the newest event of each group that nothing supersedes."""
    return latest(events.filter("superseded_by IS NULL"), by, ts)


def payload_text(payload: Column) -> Column:
    """Values of a flat JSON object in their order, joined by a blank; nulls are empty."""
    return F.array_join(F.map_values(F.from_json(payload, "map<string,string>")), " ", "")


@F.pandas_udf(StringType())
def nested_payload_text(payload):
    """The same for nested objects and lists, which no built-in walks."""
    import json

    def walk(x):
        if isinstance(x, dict):
            return " ".join(filter(None, map(walk, x.values())))
        if isinstance(x, list):
            return " ".join(filter(None, map(walk, x)))
        return "" if x is None else str(x)

    return payload.map(lambda p: walk(json.loads(p)), na_action="ignore")


def tokens(x: Column) -> Column:
    """Lower-case runs of letters and digits, accents dropped from Latin letters."""
    plain = F.translate(F.lower(x), _ACCENTED, _PLAIN)
    return F.filter(F.split(plain, r"[^\p{L}\p{N}]+"), lambda w: w != "")


# Accented Latin letters and their bases.
_ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
_PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"


def search(events: DataFrame, query: str, text: Column, user=None, ts: str = "timestamp") -> DataFrame:
    """Events whose text matches a full-text query, newest first (``matches`` has the grammar)."""
    df = events.withColumn("__t", tokens(text))
    return listing(df.filter(matches(F.col("__t"), query)).drop("__t"), user=user, ts=ts)


_TOKEN = re.compile(r'"((?:[^"]|"")*)"|([()+*,^])|([^\s"()+*,^]+)')


def matches(words: Column, query: str) -> Column:
    """Whether an array of terms matches a query.

    Terms next to each other must all be there; AND, OR and NOT combine, in
    rising order of binding OR, AND, NOT, and parentheses group. A phrase stands
    in quotes or is joined by ``+``, a last ``*`` makes its last term a prefix, a
    first ``^`` ties it to the start of the text, and ``NEAR(a b, 5)`` wants
    phrases with at most so many terms between (10 where no number is given).
    """
    found = [(m.group(1).replace('""', '"'), True) if m.group(1) is not None else (m.group(2) or m.group(3), False) for m in _TOKEN.finditer(query)]
    if not found or ":" in "".join(t for t, quoted in found if not quoted):
        raise ValueError(f"unsupported query: {query!r}")
    at = 0

    def peek(k: int = 0):
        return found[at + k] if at + k < len(found) else (None, False)

    def take(text: str | None = None):
        nonlocal at
        token = peek()
        if token[0] is None or (text is not None and token != (text, False)):
            raise ValueError(f"malformed query: {query!r}")
        at += 1
        return token

    def is_word(token) -> bool:
        text, quoted = token
        return quoted or text is not None and text not in ("AND", "OR", "NOT", "(", ")", "+", "*", ",", "^")

    def either():
        out = both()
        while peek() == ("OR", False):
            take()
            out = out | both()
        return out

    def both():
        out = without()
        while peek() == ("AND", False):
            take()
            out = out & without()
        return out

    def without():
        out = together()
        while peek() == ("NOT", False):
            take()
            out = out & ~together()
        return out

    def together():
        out = unit()
        while is_word(peek()) or peek() in (("(", False), ("^", False)):
            out = out & unit()
        return out

    def unit():
        if peek() == ("(", False):
            take()
            out = either()
            take(")")
            return out
        if peek() == ("NEAR", False) and peek(1) == ("(", False):
            take(), take()
            phrases, most = [], 10
            while is_word(peek()):
                phrases.append(phrase())
            if peek() == (",", False):
                take()
                most = int(take()[0])
            take(")")
            return _near(words, phrases, most)
        first = peek() == ("^", False)
        if first:
            take()
        terms, prefix = phrase()
        where = _places(words, terms, prefix)
        return F.array_contains(where, 0) if first else F.size(where) > 0

    def phrase() -> tuple[list[str], bool]:
        if not is_word(peek()):
            raise ValueError(f"malformed query: {query!r}")
        terms = _terms(take()[0])
        while peek() == ("+", False):
            take()
            terms += _terms(take()[0])
        prefix = peek() == ("*", False)
        if prefix:
            take()
        if not terms:
            raise ValueError(f"unsupported query: {query!r}")
        return terms, prefix

    out = either()
    if at < len(found):
        raise ValueError(f"malformed query: {query!r}")
    return out


def _terms(text: str) -> list[str]:
    return [w for w in re.split(r"[^\w]+|_", text.lower().translate(str.maketrans(_ACCENTED, _PLAIN))) if w]


def _places(words: Column, terms: list[str], prefix: bool) -> Column:
    """Where a phrase begins, from 0."""
    k = len(terms)

    def here(w, i):
        out = None
        for j, term in enumerate(terms):
            word = w if j == 0 else F.get(words, i + j)
            one = F.startswith(word, F.lit(term)) if prefix and j == k - 1 else word == term
            out = one if out is None else out & F.coalesce(one, F.lit(False))
        return out

    at = F.transform(words, lambda w, i: F.when(here(w, i), i))
    return F.array_compact(at)


def _joined(own: Column, most: int):
    """A choice of places (first start, its end, last start) with each place of a further phrase that may be near enough."""

    def join(x):
        fits = F.filter(own, lambda y: F.abs(y["a"] - x["a"]) <= most + 64)
        widened = lambda y: F.struct(
            F.least(x["a"], y["a"]).alias("a"), F.when(y["a"] < x["a"], y["b"]).otherwise(x["b"]).alias("b"), F.greatest(x["c"], y["c"]).alias("c")
        )
        return F.transform(fits, widened)

    return join


def _near(words: Column, phrases: list[tuple[list[str], bool]], most: int) -> Column:
    """Whether places of all phrases lie so that at most so many terms are between the first one's end and the last one's start."""
    spans = None
    for terms, prefix in phrases:
        k = len(terms)
        own = F.transform(_places(words, terms, prefix), lambda p: F.struct(p.alias("a"), (p + k).alias("b"), p.alias("c")))  # noqa: B023
        if spans is None:
            spans = own
            continue
        spans = F.array_distinct(F.flatten(F.transform(spans, _joined(own, most))))
    if spans is None:
        raise ValueError("NEAR without phrases")
    return F.exists(spans, lambda x: x["c"] - x["b"] <= most)
