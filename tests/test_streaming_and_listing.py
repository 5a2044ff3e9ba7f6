import os

from tandem.operators.position import latest_n
from tandem.sources.lines import list_checkpoints
from tandem.sources.sinks import read_aligned
from tandem.streaming.incremental import finalize_export, start_incremental_export


def test_incremental_export(spark, tmp_out):
    src = f"{tmp_out}/src"
    schema = "id long, en string, de string"
    spark.createDataFrame([(1, "a  b", "x"), (2, None, "y")], schema).write.parquet(f"{src}/f1")
    q = start_incremental_export(spark, f"{src}/*", schema, ["en", "de"], f"{tmp_out}/tbl", f"{tmp_out}/ck")
    q.awaitTermination()
    spark.createDataFrame([(3, "c", "z\t")], schema).write.parquet(f"{src}/f2")
    q = start_incremental_export(spark, f"{src}/*", schema, ["en", "de"], f"{tmp_out}/tbl", f"{tmp_out}/ck")
    q.awaitTermination()
    rows = finalize_export(spark, f"{tmp_out}/tbl", ["en", "de"], f"{tmp_out}/out")
    assert sorted(tuple(r) for r in rows.select("id", "en", "de").collect()) == [(1, "a b", "x"), (3, "c", "z")]
    back = read_aligned(spark, f"{tmp_out}/out", ["en", "de"]).collect()
    assert sorted((r.en, r.de) for r in back) == [("a b", "x"), ("c", "z")]


def test_checkpoint_listing_and_latest(spark, tmp_out):
    d = f"{tmp_out}/run-2502.50.200"
    os.makedirs(d)
    for name in ["m_step_900.pt", "m_step_1000.pt", "m_step_100.pt", "averaged.pt", "notes.txt"]:
        open(f"{d}/{name}", "w").write("x")
    ck = list_checkpoints(spark, d)
    assert sorted(r.step for r in ck.collect()) == [100, 900, 1000]
    last = latest_n(ck.withColumn("g", ck.path.substr(1, 0)), ["g"], ["step"], 1).first()
    assert last.step == 1000
