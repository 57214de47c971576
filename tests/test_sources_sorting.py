"""Edge-line parsing, comment filtering, CSV sort and sinks."""

import pytest
from pyspark.sql import functions as F

from quarry.operators.sorting import read_lines_in_order, sort_csv, sort_to_one
from quarry.session import scratch_path
from quarry.sinks import write_csv, write_rank_text
from quarry.sources import parse_edges, read_edge_lines, read_table_csv


def _lines(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_parse_edges_semantics(spark):
    lines = ["a b", "a\tb extra tokens", "a   b", " a b", "a ", "# c d", "single", "", "x\t\ty\t"]
    got = [tuple(r) for r in parse_edges(_lines(spark, lines)).collect()]
    assert got == [("a", "b"), ("a", "b"), ("a", "b"), ("", "a"), ("a", ""), ("x", "y")]


def test_parse_edges_flag_and_failfast(spark):
    lines = ["a b", "single"]
    flagged = parse_edges(_lines(spark, lines), mode="flag").where(F.col("malformed")).count()
    assert flagged == 1
    with pytest.raises(Exception):
        parse_edges(_lines(spark, lines), mode="failfast").collect()


def test_read_edge_lines_directory(spark):
    path = scratch_path(spark, "edges_dir")
    _lines(spark, ["a b", "# comment", "b c"]).repartition(2).write.text(path)
    assert read_edge_lines(spark, path).count() == 3
    assert read_edge_lines(spark, path + "/").count() == 3


def test_text_ordering_and_nulls_first(spark):
    df = spark.createDataFrame([("US", "10", "1"), ("US", "9", "2"), (None, "5", "3"), ("AR", "7", "4"),
                                ("", "1", "5")],
                               "cca2 string, timestamp string, o_orderkey string")
    one = sort_to_one(df, ["cca2", "timestamp", "o_orderkey"])
    assert one.rdd.getNumPartitions() == 1
    # nulls first, then the empty string, then text order ("10" < "9")
    assert [r["o_orderkey"] for r in one.collect()] == ["3", "5", "4", "1", "2"]


def test_sort_csv_single_file(spark):
    src = scratch_path(spark, "src_csv")
    dst = scratch_path(spark, "dst_csv")
    df = spark.createDataFrame([(f"c{i % 3}", str(i), str(i)) for i in range(50)], "cca2 string, timestamp string, k string")
    write_csv(df, src)
    sort_csv(spark, src, dst, ["cca2", "timestamp"], single=True)
    lines = [r["value"] for r in read_lines_in_order(spark, dst).orderBy("line_no").collect()]
    assert lines[0] == "cca2,timestamp,k"
    body = [tuple(x.split(",")) for x in lines[1:]]
    assert body == sorted(body, key=lambda t: (t[0], t[1]))
    files = [f for f in spark.read.text(dst).select(F.input_file_name()).distinct().collect()]
    assert len(files) == 1


def test_csv_roundtrip_is_all_text(spark):
    path = scratch_path(spark, "rt_csv")
    write_csv(spark.createDataFrame([(1, 2.5, None)], "a int, b double, c string"), path)
    back = read_table_csv(spark, path)
    assert [f.dataType.simpleString() for f in back.schema.fields] == ["string", "string", "string"]
    assert back.collect()[0]["c"] is None


def test_rank_text_fails_if_present(spark):
    d = scratch_path(spark, "ranks")
    ranks = spark.createDataFrame([("a", 1.0)], "id string, rank double")
    write_rank_text(ranks, d)
    assert spark.read.text(d + "/wiki.txt").collect()[0]["value"] == "('a', 1.0)"
    with pytest.raises(Exception):
        write_rank_text(ranks, d)


def test_ordered_part_files_concatenate_to_sorted(spark):
    from quarry.operators.sorting import ordered_position, sort_to_ordered_partitions
    df = spark.range(0, 3000).select((F.col("id") * 7919 % 3001).cast("string").alias("k"))
    ordered = sort_to_ordered_partitions(df, ["k"], num_partitions=6)
    assert ordered.rdd.getNumPartitions() == 6
    rows = ordered_position(ordered).orderBy("pos").collect()
    assert [r["k"] for r in rows] == sorted(r["k"] for r in rows)


def test_edges_split_at_unicode_blanks(spark):
    got = [tuple(r) for r in parse_edges(_lines(spark, ["a\u00a0b c", "x\u2003y"])).collect()]
    assert got == [("a", "b"), ("x", "y")]


def test_rank_lines_are_python_tuples(spark):
    from quarry.sinks import rank_lines
    names = ["plain", "O'Hare", 'say "hi"', "it's \"both\"", "back\\slash", "tab\there\nline", "nb\u00a0sp", "", "Zürich 日本"]
    values = [1.0, 0.15, 1.5e7, 12345678.9, 1e16, 1.5e16, 2.5e-4, 1.5e-5, 123456789012345.6, 0.0, -3.25e8, 1e22, 1e-7, 9999999.5]
    rows = [(n, v) for n in names for v in values]
    got = {r.value for r in rank_lines(spark.createDataFrame(rows, "id string, rank double")).collect()}
    assert got == {repr((n, v)) for n, v in rows}


def test_typed_csv_sort(spark):
    from quarry.operators.sorting import with_sorted_position
    path = scratch_path(spark, "typed")
    write_csv(spark.createDataFrame([("10",), ("9",), ("100",)], "n string"), path)
    typed = with_sorted_position(read_table_csv(spark, path, "n int"), ["n"]).orderBy("pos").collect()
    text = with_sorted_position(read_table_csv(spark, path), ["n"]).orderBy("pos").collect()
    assert [r.n for r in typed] == [9, 10, 100] and [r.n for r in text] == ["10", "100", "9"]
