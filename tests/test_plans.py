import os
import sys

import pytest

from tandem.plans.corpus import training_vocabulary

SMOKE = "/root/testdata/sf0.001"


def test_training_vocabulary_both_models(spark):
    rows = [(i, f"the cat {i % 7} sat", f"le chat {i % 5} assis") for i in range(40)]
    pairs = spark.createDataFrame(rows, "cpos long, src string, tgt string")
    uni = {r.piece for r in training_vocabulary(pairs, vocab_size=30, corpus_size=60, model="unigram").collect()}
    assert {"t", "h", "e", "c", "a"} <= uni
    bpe = training_vocabulary(pairs, vocab_size=38, corpus_size=60, model="bpe").collect()
    assert len(bpe) == 38 and all(r.score <= 0 for r in bpe)


@pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver tables not present")
def test_no_python_outside_unigram(spark):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E

    from tandem import catalog

    for name, fn in E.queries().items():
        if name not in catalog.QUERIES or name in ("unigram_vocab", "bpe_merges", "encode_counts", "filter_too_long_pieces", "discover_pairs", "split_files"):
            continue  # iterative or file-writing builders, covered elsewhere
        plan = fn(spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
        assert "EvalPython" not in plan and "MapInPandas" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_resolve_pair_and_steps(spark):
    from tandem.operators.filters import drop_blank_pairs, filter_too_long, reverse_pairs
    from tandem.plans.corpus import apply_steps, resolve_pair

    assert resolve_pair(["de"]) == ("en", "de")
    assert resolve_pair(["zh", "ru"]) == ("zh", "ru")
    assert resolve_pair(["de"], reverse=True) == ("de", "en")
    with pytest.raises(ValueError):
        resolve_pair(["a", "b", "c"])
    df = spark.createDataFrame([(1, "a b", "x"), (2, " ", "y"), (3, "c", "z " * 9)], "id long, src string, tgt string")
    out = apply_steps(df, [drop_blank_pairs, lambda d: filter_too_long(d, 5), reverse_pairs])
    assert [tuple(r) for r in out.collect()] == [(1, "x", "a b")]


@pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver tables not present")
def test_range_filter_reaches_the_scan(spark):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E

    plan = E.queries()["id_range_filter"](spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderkey" in plan and "LessThan(o_orderkey" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in plan


def test_strict_split_refuses_a_line_without_counterpart(spark):
    import pytest

    from tandem.plans.corpus import shuffle_split

    rows = [("d", k, f"s{k}", f"t{k}") for k in range(30)]
    schema = "dataset string, line_no long, src string, tgt string"
    whole = spark.createDataFrame(rows, schema)
    got = shuffle_split(whole, 5, strict=True).collect()
    assert sorted(r.pos for r in got) == list(range(30)) and sorted(r.cpos for r in got) == list(range(30))
    assert {r.pos for r in got if r.split == "valid"} == set(range(5)) and all(r.cpos == r.line_no for r in got)
    odd = whole.unionByName(spark.createDataFrame([("d", 30, "surplus", None)], schema))
    assert shuffle_split(odd, 5).count() == 30
    with pytest.raises(Exception, match="without a counterpart at d, 30"):
        shuffle_split(odd, 5, strict=True)


def test_split_without_texts_gives_the_same_positions(spark, tmp_path):
    from tandem.plans.corpus import read_pair_files, shuffle_split
    from tandem.sources.lines import read_lines

    for base in ("one", "two"):
        (tmp_path / f"{base}.src").write_text("".join(f"{base} s{k}\n" if k % 7 else " \n" for k in range(40)))
        (tmp_path / f"{base}.tgt").write_text("".join(f"{base} t{k}\n" for k in range(35)))
    pairs = read_pair_files(spark, str(tmp_path), "src", "tgt")
    cols = ["dataset", "line_no", "cpos", "pos", "split"]
    whole = shuffle_split(pairs, 5)
    bare = shuffle_split(pairs, 5, texts=False)
    assert {"src", "tgt"} <= set(whole.columns) and sorted(bare.columns) == sorted(cols)
    rows = sorted(map(tuple, whole.select(cols).collect()))
    assert len(rows) == 60 and sorted(map(tuple, bare.select(cols).collect())) == rows
    plan = read_lines(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan  # no line is shuffled for its number
