"""Scalar text expressions (all built-in Spark functions, so they stay inside codegen).

Every function takes and returns a ``Column``; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values. The whitespace set that Python's ``str.strip()``/``str.split()`` use
# (Unicode White_Space plus the four information separators 0x1C-0x1F), written in a
# regex syntax that both Java regex (Spark) and RE2 (DuckDB) accept.
WS_CLASS = (
    r"[\t\n\x0b\f\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
# The same set as a plain string of characters, for ``btrim`` (no regex needed).
WS_CHARS = (
    "\t\n\x0b\x0c\r \x1c\x1d\x1e\x1f\x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
STRIP_PATTERN = rf"^{WS_CLASS}+|{WS_CLASS}+$"
BLANK_PATTERN = rf"^{WS_CLASS}*$"
# Control characters the cleaner turns into spaces: CR, LF, TAB, NUL.
CONTROL_PATTERN = r"[\r\n\t\x00]"
# Subword word-start marker (U+2581), as used by the subword trainer's vocabularies.
WORD_START = "▁"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip_ws(c) -> Column:
    """Strip Unicode whitespace at both ends (plain ``trim`` only strips U+0020)."""
    return F.btrim(_c(c), F.lit(WS_CHARS))


def is_blank(c) -> Column:
    """True for NULL, empty, or whitespace-only text."""
    c = _c(c)
    return c.isNull() | (strip_ws(c) == F.lit(""))


def is_missing(c) -> Column:
    """The raw emptiness test: NULL or the empty string (no cleaning)."""
    c = _c(c)
    return c.isNull() | (c == F.lit(""))


def sanitize(c, squeeze: str = "full") -> Column:
    """Controls to spaces, squeeze runs of spaces, strip the ends.

    ``squeeze="full"``: every run of two or more spaces becomes one.
    ``squeeze="compat"``: one left-to-right pass of ``"  " -> " "`` (a run of n spaces
    becomes ceil(n/2) spaces), the behaviour of the original cleaner.
    """
    if squeeze == "full":
        # controls become spaces and runs of spaces become one: a single pass over
        # runs of controls and spaces gives the same text
        return strip_ws(F.regexp_replace(_c(c), r"[\r\n\t\x00 ]+", " "))
    t = F.regexp_replace(_c(c), CONTROL_PATTERN, " ")
    if squeeze == "compat":
        t = F.replace(t, F.lit("  "), F.lit(" "))
    elif squeeze != "none":
        raise ValueError(f"unknown squeeze mode {squeeze!r}")
    return strip_ws(t)


def spaces_only(c) -> Column:
    """Every whitespace character of the set replaced by U+0020 (a code-point map)."""
    return F.translate(_c(c), WS_CHARS, " " * len(WS_CHARS))


def words(c) -> Column:
    """Whitespace tokens of a text as an array (``str.split()`` semantics); blank gives [].

    Whitespace is mapped to U+0020 first, so the split is on a single literal character.
    """
    return F.filter(F.split(spaces_only(c), " ", -1), lambda t: t != F.lit(""))


def n_words(c) -> Column:
    return F.size(words(c)).cast("bigint")


def n_bytes(c) -> Column:
    return F.octet_length(_c(c)).cast("bigint")


def chars(c) -> Column:
    """Array of the code points of a string (surrogate pairs stay whole); '' gives ['']."""
    return F.split(_c(c), "", -1)


def first_number(c) -> Column:
    """First run of ASCII digits as a bigint; NULL when there is none."""
    s = F.regexp_extract(_c(c), r"(\d+)", 1)
    return F.when(s == "", F.lit(None).cast("bigint")).otherwise(s.try_cast("bigint"))


def step_number(path, rule: str = "step") -> Column:
    """Training step of a checkpoint path.

    ``rule="step"`` reads ``_step_<n>.`` from the file name; ``rule="first_number"``
    takes the first digit run of the whole path (the original behaviour, which ties
    when the run folder itself holds digits).
    """
    p = _c(path)
    if rule == "first_number":
        return first_number(p)
    name = F.regexp_extract(p, r"([^/\\]+)$", 1)
    s = F.regexp_extract(name, r"_step_(\d+)\.", 1)
    return F.when(s == "", F.lit(None).cast("bigint")).otherwise(s.try_cast("bigint"))


def split_piece_score(line) -> Column:
    """Split a vocabulary line into at most two whitespace-separated fields."""
    return F.split(strip_ws(line), rf"{WS_CLASS}+", 2)


def logprob_to_freq(score) -> Column:
    """Log-probability to a pseudo frequency: truncate(exp(score) * 1e6) + 1."""
    return (F.exp(_c(score)) * F.lit(1000000.0)).cast("bigint") + F.lit(1)


def perm_key(seed, id_col) -> Column:
    """Seeded, reproducible sort key of a row id: md5('<seed>:<id>') as hex text."""
    return F.md5(F.concat(F.lit(str(seed)), F.lit(":"), _c(id_col).cast("string")))


def version_tag(date_col, vocab_size, corpus_size, bpe) -> Column:
    """Run version ``yyMM.<vocab/1000>.<corpus/1e6>[.bpe]`` with half-to-even rounding."""
    return F.concat(
        F.date_format(_c(date_col), "yyMM"),
        F.lit("."),
        F.bround(_c(vocab_size) / F.lit(1000.0)).cast("bigint").cast("string"),
        F.lit("."),
        F.bround(_c(corpus_size) / F.lit(1000000.0)).cast("bigint").cast("string"),
        F.when(_c(bpe), F.lit(".bpe")).otherwise(F.lit("")),
    )
