"""Sheets read in splits equal Spark's ``multiLine`` reader row for row."""

import random

import pytest

from vaani.sources import files, sheets


def cell(rng):
    text = "".join(rng.choice(["a", "b", "é", ",", '"', "\n", "\r\n", " ", "की", "x" * 30]) for _ in range(rng.randint(0, 8)))
    if any(c in text for c in ',"\n\r'):
        return '"' + text.replace('"', '""') + '"'
    return rng.choice([text, text, f'"{text}"', 'in"side' if rng.random() < 0.2 else text])


def sheet(rng, n, end="\n"):
    rows = [",".join([str(i), cell(rng), cell(rng), cell(rng)]) for i in range(n)]
    return end.join(["id,one,Two words,three", *rows]) + rng.choice(["", end])


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def old(spark, path):
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


@pytest.mark.parametrize("seed,end,split", [(1, "\n", 300), (2, "\r\n", 300), (3, "\n", 64), (4, "\n", 1 << 20)])
def test_equals_the_multiline_reader(spark, tmp_path, seed, end, split):
    rng = random.Random(seed)
    for i in range(2):
        (tmp_path / f"s{i}.csv").write_bytes((("﻿" if i else "") + sheet(rng, 150, end)).encode())
    (tmp_path / "long.csv").write_bytes(('id,one,Two words,three\n1,"' + "line\n" * 400 + '",b,c\n2,x,"y ""q""\n",z\n').encode())
    had = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        want, got = old(spark, str(tmp_path)), sheets.read_sheet(spark, str(tmp_path))
        assert got.columns == want.columns
        assert bag(got) == bag(want)
        if split < 1000:
            assert sheets._lines(spark, str(tmp_path)).rdd.getNumPartitions() > 20
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", had[0])
        spark.conf.set("spark.sql.files.openCostInBytes", had[1])


def test_states_of_lines():
    for line, outside, inside in [("a,b", False, True), ('"a', True, False), ('a"b', False, False), ('x,"y', True, False), ('"a""b"', False, False),
                                  ('""', False, True), ('a",b', False, False), ('a"",b', False, True), ('q","r', True, True)]:
        assert (sheets.inside_after(line, False), sheets.inside_after(line, True)) == (outside, inside), line


def test_records_of_another_width_are_rescued(spark, tmp_path):
    (tmp_path / "s.csv").write_text('a,b\n1,2\n3\n4,5,6\n"x\ny",7\n')
    rows = sheets.read_sheet(spark, str(tmp_path / "s.csv"), corrupt="bad").collect()
    assert sorted((r.a, r.b, r.bad) for r in rows if r.bad is None) == [("1", "2", None), ("x\ny", "7", None)]
    assert sorted(r.bad for r in rows if r.bad is not None) == ["3", "4,5,6"]


def test_read_csv_in_splits(spark, tmp_path):
    (tmp_path / "s.csv").write_text('language,recording_id,extra\nhi,"r\n1",x\nNA,r2,y\n')
    got = files.read_csv(spark, str(tmp_path / "s.csv"), "recording_id string, language string, user_id string", na_values=True, splittable=True,
                         required=["recording_id"])
    assert {tuple(r) for r in got.collect()} == {("r\n1", "hi", None), ("r2", None, None)} and got.count() == 2
    with pytest.raises(ValueError, match="user"):
        files.read_csv(spark, str(tmp_path / "s.csv"), splittable=True, required=["user"])
    (tmp_path / "none.csv").write_text("")
    assert sheets.read_sheet(spark, str(tmp_path / "none.csv")).columns == []
