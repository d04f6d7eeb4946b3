"""The registry of queries and of the SQL that states the same in another engine."""

from __future__ import annotations

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) under its name, with SQL where SQL can express it."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def big(col):
    return col.cast("bigint")


# --- pieces of SQL -------------------------------------------------------------------------

_REST = r"\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
SPACE = rf"[\x{{09}}-\x{{0D}}{_REST}]"
LINE_SPACE = rf"[\x{{09}}\x{{0B}}-\x{{0D}}{_REST}]"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def norm_sql(x: str) -> str:
    x = f"regexp_replace({x}, '\\r\\n?', chr(10), 'g')"
    x = f"regexp_replace({x}, '[ \\t]+', ' ', 'g')"
    x = f"regexp_replace({x}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return strip_sql(f"regexp_replace({x}, '(?m)^{LINE_SPACE}+|{LINE_SPACE}+$', '', 'g')")


def fold_sql(x: str) -> str:
    return f"regexp_replace(lower({strip_sql(x)}), '{SPACE}+', ' ', 'g')"


def sentences_sql(x: str) -> str:
    parts = f"string_split_regex({x}, '[.!?。！？\\n]+')"
    return f"list_filter(list_transform({parts}, lambda s: {strip_sql('s')}), lambda s: s <> '')"


def regex_sql(pattern: str, flags: str) -> str:
    """A pattern with white space and digits of Unicode spelled out, its quotes doubled."""
    return f"(?{flags})" + pattern.replace(r"\s", SPACE).replace(r"\d", r"\p{Nd}").replace("'", "''")


def text_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def any_sql(x: str, patterns) -> str:
    return "(" + " OR ".join(f"contains({x}, '" + p.replace("'", "''") + "')" for p in patterns) + ")"


def hint_sql(x: str) -> str:
    dense = f"regexp_replace({x}, '{SPACE}', '', 'g')"
    high = f"length(regexp_replace({dense}, '[\\x{{00}}-\\x{{7F}}]', '', 'g'))"
    return (
        f"CASE WHEN length({dense}) = 0 THEN 'unknown' WHEN {high}::DOUBLE / length({dense}) > 0.5 "
        f"THEN 'majority_non_ascii' ELSE 'mostly_ascii' END"
    )


def hash_sql(seed: int, *parts: str) -> str:
    return f"sha256('{seed}'" + "".join(f" || ':' || ({p})::VARCHAR" for p in parts) + ")"
