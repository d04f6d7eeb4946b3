"""Text normalisation on columns, with one white-space class in every place.

The class is that of Unicode-aware regular expressions plus the information
separators; Java's ``\\s`` is narrower, so it is spelled out.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

# The 29 code points that count as white space.
_BLANKS = r"\t\x0B\f\r\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
LINE_SPACE = f"[{_BLANKS}]"
SPACE = rf"[\n{_BLANKS}]"
SENTENCE_END = "[.!?。！？\n]+"


def unicode_regex(pattern: str, flags: str = "iu") -> str:
    """A pattern for Java's engine with ``\\s`` and ``\\d`` as Unicode-aware ones read them; lines end in LF alone (``d``)."""
    return f"(?{flags})" + pattern.replace(r"\s", SPACE).replace(r"\d", r"\p{Nd}")


#: The same code points, one by one.
SPACES = "\n\t\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(x: Column) -> Column:
    return F.btrim(x, F.lit(SPACES))


def normalize(x: Column) -> Column:
    """Line ends to LF, blanks and tabs to one blank, at most one empty line, lines and text stripped.

    Lines are stripped after empty lines were collapsed, so lines of blanks can
    leave more than one empty line behind.
    """
    x = F.regexp_replace(x, "\r\n?", "\n")
    x = F.regexp_replace(x, "[ \t]+", " ")
    x = F.regexp_replace(x, "\n{3,}", "\n\n")
    return strip(F.regexp_replace(x, rf"(?md)^{LINE_SPACE}+|{LINE_SPACE}+$", ""))


def fold(x: Column) -> Column:
    """Stripped, lower case, any white space one blank: what substring tests look at.

    Each character has one lower case of its own, as in SQL: a dotted capital I
    is an i without a mark, and a sigma is the same at the end of a word.
    """
    x = F.replace(F.replace(strip(x), F.lit("\u0130"), F.lit("i")), F.lit("\u03a3"), F.lit("\u03c3"))
    return F.regexp_replace(F.lower(x), f"{SPACE}+", " ")


def sentences(x: Column) -> Column:
    """Stripped parts between sentence ends, blank ones left out."""
    return F.filter(F.transform(F.split(x, SENTENCE_END), strip), lambda s: s != "")


def first_sentences(x: Column, n: int = 2) -> Column:
    return F.array_join(F.slice(F.split(strip(x), rf"(?<=[.!?]){SPACE}+"), 1, n), " ")


def first_words(x: Column, n: int) -> Column:
    return F.array_join(F.slice(F.split(fold(x), " "), 1, n), " ")


def non_ascii_share(x: Column) -> Column:
    """Share of code points over 127 among those that are not white space; null when there are none."""
    dense = F.regexp_replace(x, SPACE, "")
    high = F.length(F.regexp_replace(dense, r"[\x00-\x7F]", ""))
    return high / F.nullif(F.length(dense), F.lit(0))


def language_hint(x: Column, threshold: float = 0.5) -> Column:
    share = non_ascii_share(x)
    return (
        F.when(share.isNull(), "unknown")
        .when(share > F.lit(threshold), "majority_non_ascii")
        .otherwise("mostly_ascii")
    )


def strip_html(x: Column, closed: bool = False) -> Column:
    """Tags to blanks, every entity to its characters, white space to one blank; ``closed``: only entities with a semicolon."""
    x = unescape(F.regexp_replace(x, "<[^>]+>", " "), closed)
    return strip(F.regexp_replace(x, f"{SPACE}+", " "))


def unescape(x: Column, closed: bool = False) -> Column:
    """HTML entities, named or numbered, with or (unless ``closed``) without semicolon; only texts with an ampersand leave the JVM."""
    return F.coalesce((_unescape_closed if closed else _unescape)(F.when(F.contains(x, F.lit("&")), x)), x)


@F.arrow_udf(StringType())
def _unescape(x):
    # No built-in has the table of entities.
    import html

    import pyarrow as pa

    return pa.array([None if v is None else html.unescape(v) for v in x.to_pylist()], pa.string())


@F.arrow_udf(StringType())
def _unescape_closed(x):
    import html
    import re

    import pyarrow as pa

    entity = re.compile("&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[0-9A-Za-z]+);")

    def char(m):
        # A name that the table lacks stays, even where the start of it is one.
        return html.unescape(m[0]) if m[0][1] == "#" or m[0][1:] in html.entities.html5 else m[0]

    return pa.array([None if v is None else entity.sub(char, v) for v in x.to_pylist()], pa.string())


def section(x: Column, heading: str = r"(?:conclusions?|discussion)", limit: int = 1400) -> Column:
    """Text from a heading to the next heading, shortened at a word boundary."""
    body = F.regexp_extract(x, rf"(?is)<h[1-6][^>]*>[^<]*{heading}[^<]*</h[1-6]>(.*?)(?:<h[1-6]|\z)", 1)
    return shorten(strip_html(body), limit)


def shorten(x: Column, limit: int) -> Column:
    """At most ``limit`` characters, cut between words with three dots."""
    head = F.regexp_extract(x, rf"(?s)\A(.{{0,{limit - 3}}})(?:{SPACE}|\z)", 1)
    return F.when(F.length(x) <= limit, x).otherwise(F.concat(head, F.lit("...")))


def storage_name(x: Column) -> Column:
    """A file-system name of an identifier."""
    x = F.regexp_replace(F.replace(x, F.lit("/"), F.lit("__")), "[^A-Za-z0-9._-]", "_")
    return F.regexp_replace(x, r"\A[._]+|[._]+\z", "")


def slug(x: Column) -> Column:
    return F.lower(storage_name(x))


def contains_any(x: Column, patterns: list[str]) -> Column:
    """Whether any pattern is a substring; one array literal instead of a long disjunction."""
    if not patterns:
        return F.lit(False)
    return F.exists(F.array(*map(F.lit, patterns)), lambda p: F.contains(x, p))


def count_contained(x: Column, phrases: Column) -> Column:
    """How many entries of an array occur in folded text; empty ones do not count."""
    return F.size(F.filter(F.transform(phrases, fold), lambda p: (p != "") & F.contains(x, p)))


def clamp(x: Column) -> Column:
    return F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))


def human_count(n: Column) -> Column:
    """Parameter counts for people: 1.50B, 350.0M, n/a."""
    return (
        F.when(n.isNull(), "n/a")
        .when(n >= 1_000_000_000, F.concat(fixed(n / 1e9, F.lit(2)), F.lit("B")))
        .otherwise(F.concat(fixed(n / 1e6, F.lit(1)), F.lit("M")))
    )


@F.arrow_udf(StringType())
def fixed(x, digits):
    """A number with so many decimals, rounded from its exact binary value (built-ins round its shortest decimal form)."""
    import pyarrow as pa

    return pa.array([None if v is None else f"{v:.{k}f}" for v, k in zip(x.to_pylist(), digits.to_pylist(), strict=True)], pa.string())
