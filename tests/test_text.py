from pyspark.sql import functions as F

from tandem.functions.text import (
    first_number,
    is_blank,
    logprob_to_freq,
    sanitize,
    step_number,
    strip_ws,
    version_tag,
    words,
)
from tandem.operators.filters import complete_rows


def one_col(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("t"))).collect()]


def test_spaces_full_and_compat(spark):
    vals = ["a  b", "a   b", "a    b"]
    assert one_col(spark, vals, lambda c: sanitize(c)) == ["a b", "a b", "a b"]
    assert one_col(spark, vals, lambda c: sanitize(c, "compat")) == ["a b", "a  b", "a  b"]


def test_controls_become_spaces(spark):
    assert one_col(spark, ["x\r\ny\tz\0"], lambda c: sanitize(c)) == ["x y z"]
    assert one_col(spark, ["x\r\ny\tz\0"], lambda c: sanitize(c, "compat")) == ["x y z"]


def test_unicode_strip_rule(spark):
    vals = ["　a ", "\x1cb\x85", "﻿c​"]
    # U+FEFF and U+200B are not whitespace for str.strip(), so they stay
    assert one_col(spark, vals, strip_ws) == [v.strip() for v in vals]


def test_strip_matches_python_for_every_whitespace(spark):
    ws = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    vals = [f"{w}x{w}" for w in ws] + [f"{chr(c)}y" for c in range(1, 0x3100)]
    assert one_col(spark, vals, strip_ws) == [v.strip() for v in vals]


def test_words_and_blank(spark):
    vals = ["  a　b  c ", "", " \n ", "one"]
    assert one_col(spark, vals, words) == [v.split() for v in vals]
    assert one_col(spark, vals + [None], is_blank) == [False, True, True, False, True]


def test_absent_vs_empty(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " \n "), (4, "ok")], "id long, en string")
    clean = sorted(r.id for r in complete_rows(df, ["en"]).collect())
    raw = sorted((r.id, r.en) for r in complete_rows(df, ["en"], drop_when="raw").collect())
    assert clean == [4]
    assert raw == [(3, ""), (4, "ok")]


def test_numbers_and_steps(spark):
    paths = ["/r/en-xx-2502.50.200/m_step_900.pt", "/r/en-xx-2502.50.200/m_step_1000.pt", "none"]
    assert one_col(spark, paths, lambda c: step_number(c)) == [900, 1000, None]
    assert one_col(spark, paths, lambda c: step_number(c, "first_number")) == [2502, 2502, None]
    assert one_col(spark, ["http://a.example/x/825?p=2"], first_number) == [825]


def test_logprob_to_freq(spark):
    df = spark.createDataFrame([(-1.5,), (0.0,), (-20.0,)], "s double")
    assert [r[0] for r in df.select(logprob_to_freq(F.col("s"))).collect()] == [223131, 1000001, 1]


def test_version_tag(spark):
    df = spark.createDataFrame([("2025-02-28",)], "d string").select(F.to_date("d").alias("d"))
    v = df.select(version_tag(F.col("d"), F.lit(50000), F.lit(200000000), F.lit(False))).first()[0]
    assert v == "2502.50.200"
    v = df.select(version_tag(F.col("d"), F.lit(2500), F.lit(5000), F.lit(True))).first()[0]
    assert v == "2502.2.0.bpe"  # 2.5 rounds half to even


def test_no_python_in_text_plans(spark):
    df = spark.createDataFrame([("a  b",)], "t string").select(sanitize("t"), words("t"), is_blank("t"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
