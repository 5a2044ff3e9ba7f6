import os


from tandem.sources.lines import discover_pairs, line_stats, read_lines, split_lines


def write(path, data: bytes):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def test_split_lines_file_semantics(spark):
    df = spark.createDataFrame([(1, "a\rb\nc\n"), (2, ""), (3, "x\n\ny"), (4, None)], "k long, t string")
    out = sorted((r.k, r.line_no, r.line) for r in split_lines(df, "t", ["k"]).collect())
    assert out == [(1, 0, "a\rb"), (1, 1, "c"), (3, 0, "x"), (3, 1, ""), (3, 2, "y")]


def test_read_lines_exact_numbers_across_splits(spark, tmp_out):
    lines = [f"line {i} " + "x" * (i % 37) for i in range(4000)]
    lines[5] = "a\rb"  # a lone CR stays inside its line
    lines[7] = ""
    lines[9] = "　"
    write(f"{tmp_out}/big.txt", ("\n".join(lines) + "\n").encode())
    write(f"{tmp_out}/small.txt", b"one\ntwo")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")  # force many splits
    try:
        df = read_lines(spark, tmp_out)
        got = {(os.path.basename(r.path), r.line_no): r.line for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = {("big.txt", i): s for i, s in enumerate(lines)}
    want.update({("small.txt", 0): "one", ("small.txt", 1): "two"})
    assert got == want


def test_line_stats(spark):
    df = spark.createDataFrame([("f", 0, "ab"), ("f", 1, "é")], "f string, line_no long, line string")
    r = line_stats(df, ["f"]).first()
    assert (r.n_lines, r.last_line, r.n_bytes) == (2, "é", 3 + 3)


def test_discover_pairs(spark, tmp_out):
    write(f"{tmp_out}/corp/a.en", b"1\n")
    write(f"{tmp_out}/corp/a.de", b"2\n")
    write(f"{tmp_out}/corp/b.en", b"3\n")
    write(f"{tmp_out}/corp/c.de/part-0.txt", b"4\n")
    write(f"{tmp_out}/corp/c.en/part-0.txt", b"5\n")
    pairs, orphans = discover_pairs(spark, f"{tmp_out}/corp", "en", "de")
    assert sorted(r.base for r in pairs.collect()) == ["a", "c"]
    assert [r.base for r in orphans.collect()] == ["b"]


def test_collections_from_json_exports(spark, tmp_out):
    from tandem.operators.align import align_collections
    from tandem.sources.collections import read_collection, read_wide

    write(f"{tmp_out}/en.json", b'{"_id": 1, "text": "hello"}\n{"_id": 2, "text": "bye"}\n')
    write(f"{tmp_out}/zh.json", b'{"_id": 2, "text": "zai jian"}\n{"_id": 3, "text": "x"}\n')
    write(f"{tmp_out}/wide.json", b'{"_id": 5, "en": "a", "zh": "b", "extra": 1}\n')
    en = read_collection(spark, f"{tmp_out}/en.json", fmt="json", id_col="_id")
    zh = read_collection(spark, f"{tmp_out}/zh.json", fmt="json", id_col="_id")
    assert [tuple(r) for r in align_collections({"en": en, "zh": zh}).collect()] == [(2, "bye", "zai jian")]
    wide = read_wide(spark, f"{tmp_out}/wide.json", ["en", "zh"], fmt="json", id_col="_id")
    assert wide.columns == ["id", "en", "zh"] and [tuple(r) for r in wide.collect()] == [(5, "a", "b")]
