"""Files laid out along a curve can be skipped by either column, which the footers tell."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import millrace as m
from millrace.functions.curves import curve_place


def ranges(path, column):
    found = []
    for file in sorted(path.rglob("*.parquet")):
        meta = pq.ParquetFile(file)
        at = meta.schema_arrow.names.index(column)
        stats = [meta.metadata.row_group(g).column(at).statistics for g in range(meta.metadata.num_row_groups)]
        found += [(min(s.min for s in stats if s), max(s.max for s in stats if s))] if meta.metadata.num_rows else []
    return found


def skipped(path, column, low, high):
    found = ranges(path, column)
    return sum(b < low or a > high for a, b in found) / len(found)


@pytest.fixture
def frame(spark):
    return spark.range(20_000).select(
        F.col("id"),
        (F.hash("id") % 1000).alias("a"),
        F.exp((F.xxhash64("id") % 1000) / 300).alias("b"),
        F.concat(F.lit("k"), F.lpad(F.pmod(F.hash(F.col("id") + 7), F.lit(500)), 3, "0")).alias("t"),
    )


@pytest.mark.parametrize("second", ["b", "t"])
def test_either_column_skips_half_of_the_files(spark, tmp_path, frame, second):
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    try:
        m.write_table(m.lay_out_by_curve(frame, ["a", second]), str(tmp_path / "curve"), "overwrite")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert len(ranges(tmp_path / "curve", "a")) >= 12
    assert skipped(tmp_path / "curve", "a", 100, 110) >= 0.5
    low = frame.select(second).orderBy(second).limit(3000).agg(F.max(second)).first()[0]
    assert skipped(tmp_path / "curve", second, low, low) >= 0.5
    back = m.read_target(spark, str(tmp_path / "curve"))
    assert back.count() == 20_000 and back.exceptAll(frame).isEmpty()


def test_nulls_one_value_and_partitions(spark, tmp_path):
    df = spark.createDataFrame([(None, None, "p"), (1, "x", "q"), (1, "x", "p")] * 50, "a int, t string, p string")
    m.write_table(m.lay_out_by_curve(df, ["a", "t"], ["p"]), str(tmp_path / "x"), "overwrite", partition_by=["p"])
    assert m.read_target(spark, str(tmp_path / "x")).count() == 150
    assert df.select(curve_place(df, ["a", "t"])).distinct().count() == 1
    assert m.lay_out_by_curve(df.limit(0), ["a", "t"]).collect() == []
    with pytest.raises(ValueError, match="no place"):
        curve_place(df.select(F.array("a").alias("many")), ["many"])
