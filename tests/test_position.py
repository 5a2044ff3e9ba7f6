import random

from pyspark.sql import functions as F

from tandem.functions.text import perm_key
from tandem.operators.position import (
    cap_per_group,
    global_position,
    latest_n,
    line_bucket,
    line_super_bucket,
    permute,
)
from tandem.operators.split import sample_rows, train_valid_split


def test_permutation_is_bijection_and_partition_independent(spark):
    df = spark.range(0, 3000).withColumn("x", F.col("id") * 2)
    a = {r.id: r.pos for r in permute(df.repartition(1)).collect()}
    b = {r.id: r.pos for r in permute(df.repartition(7), hex_chars=2).collect()}
    assert a == b
    assert sorted(a.values()) == list(range(3000))
    keys = sorted(df.select("id", perm_key(42, F.col("id")).alias("k")).collect(), key=lambda r: (r.k, r.id))
    assert [r.id for r in keys] == [i for i, _ in sorted(a.items(), key=lambda kv: kv[1])]


def test_global_position_two_level_equals_python(spark):
    rnd = random.Random(3)
    rows = [(d, n) for d in range(40) for n in range(rnd.randint(0, 30))]
    df = spark.createDataFrame(rows, "doc long, line_no long")
    one = global_position(df, ["doc", "line_no"], line_bucket(["doc"], block=7))
    two = global_position(df, ["doc", "line_no"], line_bucket(["doc"], block=7), super_bucket=line_super_bucket(["doc"], 4))
    want = {r: i for i, r in enumerate(sorted(rows))}
    assert {(r.doc, r.line_no): r.pos for r in one.collect()} == want
    assert {(r.doc, r.line_no): r.pos for r in two.collect()} == want


def test_cap_over_two_datasets(spark):
    df = spark.createDataFrame([("a", 0), ("a", 1), ("a", 2), ("b", 0)], "dataset string, line_no long")
    out = cap_per_group(df, "dataset", [F.col("line_no")], F.floor(F.col("line_no") / 2), 2)
    assert sorted((r.dataset, r.line_no) for r in out.collect()) == [("a", 0), ("a", 1), ("b", 0)]


def test_oversize_validation(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    out = train_valid_split(df, 10)
    assert sorted(r.split for r in out.collect()) == ["valid"] * 3


def test_split_disjoint_and_complete(spark):
    df = spark.range(0, 500)
    out = train_valid_split(df, 50).collect()
    assert sum(r.split == "valid" for r in out) == 50
    assert sorted(r.id for r in out) == list(range(500))
    assert sample_rows(df, 20).count() == 20


def test_latest_n_and_group_limit(spark):
    df = spark.createDataFrame([(u, t) for u in range(3) for t in range(10)], "u long, t long")
    out = latest_n(df, ["u"], ["t"], 2)
    assert sorted((r.u, r.t) for r in out.collect()) == [(u, t) for u in range(3) for t in (8, 9)]
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_approx_sample_is_seeded_and_near_fraction(spark):
    from tandem.operators.split import approx_sample

    df = spark.range(0, 20000)
    a = {r.id for r in approx_sample(df, 0.1).collect()}
    b = {r.id for r in approx_sample(df.repartition(5), 0.1).collect()}
    assert a == b
    assert 1700 < len(a) < 2300


def test_ranking_runs_its_input_once(spark):
    from tandem.operators.position import permute

    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.range(5000).select((F.col("id") * 3).alias("id")).mapInArrow(count, "id bigint")
    got = {r.id: r.pos for r in permute(rows, seed=7).collect()}
    want = {r.id: k for k, r in enumerate(spark.range(5000).select((F.col("id") * 3).alias("id")).orderBy(F.md5(F.concat(F.lit("7:"), F.col("id").cast("string")))).collect())}
    assert got == want and seen.value == 5000


def test_ranks_by_group_with_nulls_and_ties(spark):
    from tandem.operators.position import ranked

    rows = [(g, k % 5, k) for g in ("a", None, "") for k in range(40)] + [("b", None, 1)]
    frame = spark.createDataFrame(rows, "g string, k int, id int").repartition(6)
    got = ranked(frame, [F.col("k").asc_nulls_first(), "id"], ["g"], total_col="n").collect()
    for g in ("a", None, "", "b"):
        mine = sorted((r.pos, r.n, r.k, r.id) for r in got if r.g == g)
        want = sorted((-1 if k is None else k, i) for x, k, i in rows if x == g)
        assert [(m[0], m[1]) for m in mine] == [(p, len(want)) for p in range(len(want))]
        assert [(-1 if m[2] is None else m[2], m[3]) for m in mine] == want
    assert ranked(frame.limit(0), ["id"], ["g"]).count() == 0
