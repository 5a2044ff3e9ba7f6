import pytest

from tandem.operators.align import align_collections, lookup_array, unwind, zip_lines
from tandem.operators.checks import alignment_report, assert_aligned, dedup_pairs
from tandem.operators.filters import drop_blank_pairs


def test_n_way_join_drops_missing(spark):
    en = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, text string")
    de = spark.createDataFrame([(1, "x"), (3, "z")], "id long, text string")
    fr = spark.createDataFrame([(3, "q"), (1, "p"), (4, "r")], "id long, text string")
    out = align_collections({"en": en, "de": de, "fr": fr}, ["en", "de", "fr"])
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a", "x", "p"), (3, "c", "z", "q")]


def test_lookup_then_unwind_drops_empty(spark):
    left = spark.createDataFrame([(1,), (2,)], "k long")
    right = spark.createDataFrame([(1, "a"), (1, "b")], "rk long, v string")
    looked = lookup_array(left, right, "k", "rk", "m")
    sizes = {r.k: len(r.m) for r in looked.collect()}
    assert sizes == {1: 2, 2: 0}
    assert sorted((r.k, r.m.v) for r in unwind(looked, "m").collect()) == [(1, "a"), (1, "b")]


def lines(spark, rows):
    return spark.createDataFrame(rows, "dataset string, line_no long, line string")


def test_one_sided_blank_keeps_alignment(spark):
    src = lines(spark, [("d", 0, "a"), ("d", 1, " "), ("d", 2, "c"), ("d", 3, "e")])
    tgt = lines(spark, [("d", 0, "A"), ("d", 1, "B"), ("d", 2, "C"), ("d", 3, "")])
    z = zip_lines(src, tgt, mode="report")
    kept = sorted((r.src, r.tgt) for r in drop_blank_pairs(z).collect())
    assert kept == [("a", "A"), ("c", "C")]
    rep = alignment_report(z).first()
    assert (rep.src_only_blank, rep.tgt_only_blank, rep.aligned) == (1, 1, False)


def test_unequal_files_report_and_strict(spark):
    src = lines(spark, [("d", i, f"s{i}") for i in range(5)])
    tgt = lines(spark, [("d", i, f"t{i}") for i in range(4)])
    rep = alignment_report(zip_lines(src, tgt, mode="report")).first()
    assert (rep.src_surplus, rep.tgt_surplus) == (1, 0)
    with pytest.raises(ValueError):
        assert_aligned(alignment_report(zip_lines(src, tgt, mode="report")))
    for one, other in ((src, tgt), (tgt, src)):
        with pytest.raises(Exception, match="surplus line without a counterpart at d, 4"):
            zip_lines(one, other).collect()
    assert zip_lines(src, tgt, mode="matched").count() == 4
    assert zip_lines(tgt, tgt).count() == 4


def test_dedup_keeps_lowest_id(spark):
    df = spark.createDataFrame([(5, "a", "x"), (2, "a", "x"), (3, "a", "y"), (1, "b", "x")], "id long, src string, tgt string")
    assert sorted(tuple(r) for r in dedup_pairs(df).collect()) == [(1, "b", "x"), (2, "a", "x"), (3, "a", "y")]
    assert sorted(r.id for r in dedup_pairs(df, key="src").collect()) == [1, 2]
    assert dedup_pairs(df.repartition(3)).orderBy("id").collect() == dedup_pairs(df.coalesce(1)).orderBy("id").collect()


def test_language_code_validation(spark):
    from tandem.sources.collections import language_dim, require_known_codes, unpivot_names

    require_known_codes(spark, ["en", "zh"])
    with pytest.raises(KeyError, match="xx"):
        require_known_codes(spark, ["en", "xx"])
    names = {(r.code, r.display_lang): r.name for r in unpivot_names(language_dim(spark)).collect()}
    assert names[("de", "en")] == "German"


def test_skip_empty_levels(spark):
    from tandem.operators.filters import skip_empty

    df = spark.createDataFrame([(1, "a", "b"), (2, " ", "c")], "id long, src string, tgt string")
    assert [r.id for r in skip_empty(df).collect()] == [1]
    with pytest.raises(Exception, match="empty example"):
        skip_empty(df, level="error").collect()


def test_skip_empty_warning_counts(spark):
    from pyspark.sql import Observation

    from tandem.operators.filters import skip_empty

    df = spark.createDataFrame([(1, "a", "b"), (2, " ", "c"), (3, "d", "")], "id long, src string, tgt string")
    obs = Observation("empties")
    kept = skip_empty(df, level="warning", observation=obs)
    assert [r.id for r in kept.collect()] == [1]
    assert obs.get["empty_pairs"] == 2
