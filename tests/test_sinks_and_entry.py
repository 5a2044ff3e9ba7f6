import os
import sys

from pyspark.sql import functions as F

from tandem.plans.corpus import export_aligned, read_pair_files, shuffle_split
from tandem.sources.sinks import read_aligned, read_tsv_vocab, write_aligned, write_vocab


def test_aligned_round_trip(spark, tmp_out):
    df = spark.createDataFrame([(i, f"e{i}", f"d{i}") for i in range(0, 250, 3)], "id long, en string, de string")
    write_aligned(df, ["en", "de"], f"{tmp_out}/al", shard_width=40)
    back = read_aligned(spark, f"{tmp_out}/al", ["en", "de"]).collect()
    assert len(back) == df.count()
    assert all(r.en[1:] == r.de[1:] for r in back)
    order = sorted(back, key=lambda r: (r.shard, r.line_no))
    assert [int(r.en[1:]) for r in order] == sorted(int(r.en[1:]) for r in back)


def test_export_observe_counts(spark, tmp_out):
    en = spark.createDataFrame([(1, "a  b"), (2, " "), (3, "c")], "id long, text string")
    de = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z\t")], "id long, text string")
    kept, metrics = export_aligned({"en": en, "de": de}, ["en", "de"], f"{tmp_out}/ex")
    assert sorted(tuple(r) for r in kept.collect()) == [(1, "a b", "x"), (3, "c", "z")]
    assert metrics["rows"] == 2
    assert metrics["seconds"] > 0 and metrics["rows_per_second"] > 0


def test_vocab_round_trip(spark, tmp_out):
    v = spark.createDataFrame([("▁a", 5), ("b\"q", 2)], "piece string, freq long")
    write_vocab(v, f"{tmp_out}/v")
    assert sorted(tuple(r) for r in read_tsv_vocab(spark, f"{tmp_out}/v").collect()) == [("b\"q", 2), ("▁a", 5)]


def test_pair_files_to_split(spark, tmp_out):
    d = f"{tmp_out}/corpora"
    os.makedirs(d)
    open(f"{d}/x.en", "w").write("a\nb\n \nc\n")
    open(f"{d}/x.de", "w").write("A\nB\nC\nD\n")
    open(f"{d}/y.en", "w").write("e\n")
    open(f"{d}/y.de", "w").write("E\n")
    pairs = read_pair_files(spark, d, "en", "de")
    out = shuffle_split(pairs, 2).collect()
    assert sorted((r.src, r.tgt) for r in out) == [("a", "A"), ("b", "B"), ("c", "D"), ("e", "E")]
    assert sum(r.split == "valid" for r in out) == 2
    assert sorted(r.cpos for r in out) == [0, 1, 2, 3]


def test_entry_smoke(spark):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E

    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["id", "src", "tgt", "split", "pos"]
    assert sum(r.split == "valid" for r in rows) == min(10, len(rows))
    assert set(E.oracle_sql()) <= set(E.queries())


def test_pair_files_cap(spark, tmp_out):
    d = f"{tmp_out}/capped"
    os.makedirs(d)
    open(f"{d}/x.en", "w").write("a\nb\n\nc\n")
    open(f"{d}/x.de", "w").write("A\nB\nX\nC\n")
    open(f"{d}/y.en", "w").write("e\n")
    open(f"{d}/y.de", "w").write("E\n")
    out = shuffle_split(read_pair_files(spark, d, "en", "de"), 1, max_lines=2).collect()
    # the cap counts lines after the blank drop, per dataset
    assert sorted((r.src, r.tgt) for r in out) == [("a", "A"), ("b", "B"), ("e", "E")]


def test_manifest_round_trip(spark, tmp_out):
    from tandem.functions.text import version_tag
    from tandem.sources.sinks import write_manifest

    m = spark.range(1).select(
        F.lit("en-de").alias("pair"),
        version_tag(F.to_date(F.lit("2025-02-28")), F.lit(50000), F.lit(200000000), F.lit(False)).alias("version"),
        F.lit(7).cast("bigint").alias("n_valid"),
    )
    write_manifest(m, f"{tmp_out}/manifest")
    back = spark.read.json(f"{tmp_out}/manifest").first()
    assert (back.pair, back.version, back.n_valid) == ("en-de", "2502.50.200", 7)


def test_append_range_replaces_only_written_shards(spark, tmp_out):
    schema = "id long, en string, de string"
    write = lambda rows: write_aligned(spark.createDataFrame(rows, schema), ["en", "de"], f"{tmp_out}/k2", shard_width=50, mode="append_range")
    write([(i, f"e{i}", f"d{i}") for i in range(-5, 100)])
    # a later id range, then a corrected first range: other shards stay as they are
    write([(i, f"e{i}", f"d{i}") for i in range(100, 150)])
    write([(i, f"E{i}", f"D{i}") for i in range(50)])
    back = read_aligned(spark, f"{tmp_out}/k2", ["en", "de"]).collect()
    assert len(back) == 155 and {r.shard for r in back} == {-1, 0, 1, 2}
    assert sorted(r.shard for r in back if r.en.startswith("E")) == [0] * 50


def test_a_rerun_leaves_no_stale_rows(spark, tmp_out):
    schema = "id long, en string, de string"
    for n in (25, 5):
        write_aligned(spark.createDataFrame([(i, f"e{i}", f"d{i}") for i in range(n)], schema), ["en", "de"], f"{tmp_out}/again", shard_width=5)
        assert read_aligned(spark, f"{tmp_out}/again", ["en", "de"]).count() == n


def test_a_rerun_leaks_no_validation_pair(spark, tmp_out):
    from tandem.plans.corpus import write_splits

    rows = [("d", i, f"e{i}", f"d{i}") for i in range(25)]
    pairs = spark.createDataFrame(rows, "dataset string, line_no long, src string, tgt string")
    for n in (20, 2):
        write_splits(shuffle_split(pairs, n), f"{tmp_out}/splits")
    back = read_aligned(spark, f"{tmp_out}/splits", ["src", "tgt"], extra_partitions=["split"]).collect()
    assert len(back) == 25 and len({r.src for r in back}) == 25 and sum(r.split == "valid" for r in back) == 2


def test_export_feeds_the_split_plan(spark, tmp_out):
    en = spark.createDataFrame([(i, f"e{i}") for i in range(0, 60)], "id long, text string")
    de = spark.createDataFrame([(i, f"d{i}") for i in range(0, 60, 2)], "id long, text string")
    export_aligned({"en": en, "de": de}, ["en", "de"], f"{tmp_out}/corpora", shard_width=7, name="corpus")
    pairs = read_pair_files(spark, f"{tmp_out}/corpora", "en", "de", strict=True).collect()
    assert len(pairs) == 30 and all(r.src[1:] == r.tgt[1:] for r in pairs)
    assert {r.dataset for r in pairs} == {"corpus"}
    # line order follows id order across the zero-padded shard folders
    assert [int(r.src[1:]) for r in sorted(pairs, key=lambda r: r.line_no)] == list(range(0, 60, 2))
