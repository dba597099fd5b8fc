"""Good and rejected rows add up to the input, and rejects say what is wrong."""

import json

import pytest

import millrace as m

RAW = "id string, amount string, day string, note string"
CASTS = {"id": "int", "amount": "decimal(10,2)", "day": "date", "absent": "int"}
ROWS = [
    ("1", "2.50", "2024-01-01", "ok"),
    ("x", "abc", "2024-01-01", "two bad values"),
    ("2", None, "2024-13-01", None),
    (None, "1", "2024-01-02", "no id"),
    ("3", "-4", "2024-01-02", "negative"),
    (" 4 ", "1e1", None, "fine"),
]


def split(spark, tmp_path, rows=ROWS, **more):
    df = spark.createDataFrame(rows, RAW).repartition(3)
    marked = m.find_problems(df, CASTS, required=["id"], rules={"positive": "amount > 0"}, **more)
    counts = m.write_split(marked, str(tmp_path / "split"))
    return counts, m.read_good(spark, str(tmp_path / "split")), m.read_rejects(spark, str(tmp_path / "split"))


def test_counts_and_reasons(spark, tmp_path):
    counts, good, rejects = split(spark, tmp_path)
    assert counts == (2, 4) and sum(counts) == len(ROWS)
    assert {f.name: f.dataType.simpleString() for f in good.schema} == {"id": "int", "amount": "decimal(10,2)", "day": "date", "note": "string"}
    assert sorted((r.id, str(r.amount), r.note) for r in good.collect()) == [(1, "2.50", "ok"), (4, "10.00", "fine")]
    found = rejects.collect()
    assert sorted(((r.column, r.value, r.reason) for r in found), key=str) == sorted([
        ("id", "x", "not a int"), ("amount", "abc", "not a decimal(10,2)"), ("day", "2024-13-01", "not a date"),
        ("id", None, "missing"), (None, None, "breaks positive")], key=str)
    assert {json.loads(r.original)["note"] for r in found if r.column == "amount"} == {"two bad values"}


def test_unreadable_records(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id,amount\n1,2\nbroken,\"x\ny,z,w\n3,4\n")
    (tmp_path / "in.json").write_text('{"id": "1"}\nnot json\n{"id": "2"}\n')
    df = m.read_files(spark, str(tmp_path / "in.json"), "jsonl", "id string, bad string", {"columnNameOfCorruptRecord": "bad"})
    marked = m.find_problems(df, {"id": "int"}, unreadable="bad")
    assert m.write_split(marked, str(tmp_path / "split")) == (2, 1)
    (reject,) = m.read_rejects(spark, str(tmp_path / "split")).collect()
    assert (reject.value, reject.reason) == ("not json", "unreadable")
    assert m.read_good(spark, str(tmp_path / "split")).columns == ["id"]


def test_one_side_or_none(spark, tmp_path):
    counts, good, rejects = split(spark, tmp_path / "a", [])
    assert counts == (0, 0) and good.collect() == [] and rejects.collect() == []
    counts, good, rejects = split(spark, tmp_path / "b", [("x", "1", None, None)] * 3)
    assert counts == (0, 3) and good.collect() == [] and rejects.count() == 3


def test_clashing_and_missing_columns(spark):
    df = spark.createDataFrame([("1", "2")], "id string, _problems string")
    with pytest.raises(ValueError, match="of its own"):
        m.find_problems(df, {"id": "int"})
    with pytest.raises(ValueError, match="among the columns"):
        m.find_problems(df.select("id"), {}, required=["other"])
