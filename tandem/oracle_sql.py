"""DuckDB SQL fragments that restate the Spark expressions, for the oracle queries."""

from __future__ import annotations

from tandem.functions.text import BLANK_PATTERN, CONTROL_PATTERN, STRIP_PATTERN, WS_CLASS


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q(STRIP_PATTERN)}, '', 'g')"


def sanitize(x: str, squeeze: str = "full") -> str:
    t = f"regexp_replace({x}, {q(CONTROL_PATTERN)}, ' ', 'g')"
    if squeeze == "full":
        t = f"regexp_replace({t}, ' {{2,}}', ' ', 'g')"
    else:
        t = f"replace({t}, '  ', ' ')"
    return strip(t)


def is_blank(x: str) -> str:
    return f"({x} IS NULL OR regexp_matches({x}, {q(BLANK_PATTERN)}))"


def words(x: str) -> str:
    s = strip(x)
    return f"(CASE WHEN {s} = '' THEN []::VARCHAR[] ELSE regexp_split_to_array({s}, {q(WS_CLASS + '+')}) END)"


def n_words(x: str) -> str:
    return f"CAST(len({words(x)}) AS BIGINT)"


def perm_key(seed, id_expr: str) -> str:
    return f"md5('{seed}:' || CAST({id_expr} AS VARCHAR))"
