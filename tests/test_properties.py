"""Property tests: the cleaning rules against their plain-Python statement."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tandem.functions.text import is_blank, sanitize, words

ALPHABET = st.sampled_from(list("ab  \t\r\n\x00　 \x1c\x85﻿​é😀"))
TEXTS = st.lists(st.text(alphabet=ALPHABET, max_size=12), min_size=1, max_size=40)


def full_rule(s: str) -> str:
    return re.sub(" {2,}", " ", re.sub("[\r\n\t\x00]", " ", s)).strip()


def compat_rule(s: str) -> str:
    return re.sub("[\r\n\t\x00]", " ", s).replace("  ", " ").strip()


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(TEXTS)
def test_cleaning_rules(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.orderBy("i").select(
        sanitize("t").alias("full"), sanitize("t", "compat").alias("compat"), words("t").alias("w"), is_blank("t").alias("b")
    ).collect()
    for t, r in zip(texts, rows):
        assert r.full == full_rule(t)
        assert r.compat == compat_rule(t)
        assert list(r.w) == t.split()
        assert r.b == (t.strip() == "")
