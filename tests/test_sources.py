import pytest
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

import millrace as m
from millrace.sources.files import CSV_DEFAULTS
from millrace.sources.jdbc import jdbc_options
from millrace.storage import path_exists, scratch_path, scratch_root

JDBC = {"url": "jdbc:x:y", "driver": "a.B", "user": "u", "password": "p"}


@pytest.fixture
def csv_dir(tmp_path):
    (tmp_path / "a.csv").write_text("id,v,n\n1,NULL,1\n2,,2\n")
    (tmp_path / "b.csv").write_text("id,v,n\n3,x,bad\n")
    (tmp_path / "c.txt").write_text("id,v,n\n9,z,9\n")
    return str(tmp_path)


def test_csv_defaults(spark, csv_dir):
    df = m.read_files(spark, f"{csv_dir}/*.csv", "csv")
    assert dict(df.dtypes) == {"id": "int", "v": "string", "n": "string"}
    assert sorted(tuple(r) for r in df.collect()) == [(1, None, "1"), (2, None, "2"), (3, "x", "bad")]


def test_csv_options_win_and_are_not_changed(spark, csv_dir):
    options = {"nullValue": "x", "header": "false"}
    df = m.read_files(spark, f"{csv_dir}/b.csv", "csv", options=options)
    assert [tuple(r) for r in df.collect()] == [("id", "v", "n"), ("3", None, "bad")]
    assert options == {"nullValue": "x", "header": "false"}
    assert CSV_DEFAULTS == {"header": "true", "inferSchema": "true", "nullValue": "NULL"}


def test_csv_schema(spark, csv_dir):
    schema = StructType([StructField("id", StringType()), StructField("v", StringType()), StructField("n", IntegerType())])
    df = m.read_files(spark, f"{csv_dir}/*.csv", "csv", schema=schema)
    assert df.schema == schema
    assert sorted(r.n if r.n else 0 for r in df.collect()) == [0, 1, 2]
    assert m.read_files(spark, f"{csv_dir}/a.csv", "csv", schema="id int, v string, n int").count() == 2


def test_several_paths(spark, csv_dir):
    assert m.read_files(spark, [f"{csv_dir}/a.csv", f"{csv_dir}/b.csv"], "csv").count() == 3


def test_json_lines_with_a_bad_one(spark, tmp_path):
    file = tmp_path / "e.jsonl"
    file.write_text('{"id": 1, "o": {"x": "y"}}\nnot json\n')
    rows = m.read_files(spark, str(file), "jsonl").collect()
    assert [r._corrupt_record for r in rows] == [None, "not json"]
    assert rows[0].o.x == "y"


def test_multi_line_json(spark, tmp_path):
    file = tmp_path / "e.json"
    file.write_text('[{"id": 1},\n {"id": 2}]')
    assert m.read_files(spark, str(file), "json", options={"multiLine": "true"}).count() == 2


@pytest.mark.parametrize("format", ["parquet", "orc"])
def test_columnar_formats_push_down(spark, tmp_path, format):
    path = str(tmp_path / format)
    spark.range(10).selectExpr("id", "id * 2 AS twice", "'x' AS v").write.format(format).save(path)
    df = m.read_files(spark, path, format).where("id > 7").select("twice")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,7)" in plan and "ReadSchema: struct<id:bigint,twice:bigint>" in plan
    assert sorted(r.twice for r in df.collect()) == [16, 18]


def test_unknown_format(spark):
    with pytest.raises(ValueError, match="xlsx"):
        m.read_files(spark, "/absent", "xlsx")


def test_delta_without_its_data_source(spark, tmp_path):
    with pytest.raises(RuntimeError, match="delta"):
        m.read_files(spark, str(tmp_path), "delta")


def test_other_read_errors_pass_through(spark):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        m.read_files(spark, "/absent/path", "parquet")


def test_count_rows_fills_with_the_write(spark, tmp_path):
    counted, seen = m.count_rows(spark.range(7), "seven")
    counted.write.parquet(str(tmp_path / "out"))
    assert seen.get == {"rows": 7}


# A database would have to be started to read from one; the options are what this module decides.


@pytest.mark.parametrize(
    "given, relation",
    [
        ("sales.orders", "sales.orders"),
        ("selections", "selections"),
        ("SELECT * FROM orders", "(SELECT * FROM orders) AS src"),
        ("  select 1;", "(select 1) AS src"),
        ("WITH a AS (SELECT 1) SELECT * FROM a", "(WITH a AS (SELECT 1) SELECT * FROM a) AS src"),
    ],
)
def test_jdbc_relation(given, relation):
    assert jdbc_options(table_or_query=given, **JDBC)["dbtable"] == relation


def test_jdbc_plain_options():
    options = jdbc_options(table_or_query="t", **JDBC, extra_options={"fetchsize": "10000"})
    assert options == JDBC | {"dbtable": "t", "fetchsize": "10000"}
    assert "user" not in jdbc_options("jdbc:x", "t", "a.B")


def test_jdbc_partitioning_accepts_a_zero_bound():
    options = jdbc_options(table_or_query="t", **JDBC, partition_column="k", lower_bound=0, upper_bound=40)
    assert {k: options[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")} == {
        "partitionColumn": "k", "lowerBound": "0", "upperBound": "40", "numPartitions": "4"
    }
    for bounds in ({"lower_bound": 0}, {"upper_bound": 9}, {}):
        with pytest.raises(ValueError, match="lower_bound"):
            jdbc_options(table_or_query="t", **JDBC, partition_column="k", **bounds)


def test_jdbc_read_reaches_the_jdbc_source(spark):
    with pytest.raises(Exception, match="no.such.Driver"):
        m.read_jdbc(spark, "jdbc:x:y", "t", "no.such.Driver")


def test_scratch_is_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark) == root
    first, second = scratch_path(spark, "a"), scratch_path(spark, "a")
    assert first != second and first.startswith(f"{root}/a-")
    assert not path_exists(spark, first)
    spark.range(1).write.parquet(first)
    assert path_exists(spark, first)


class _Session:
    """Just the settings of a session."""

    def __init__(self, **settings):
        self.conf = self
        self.settings = {k.replace("_", "."): v for k, v in settings.items()}

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_scratch_is_shared():
    named = _Session(spark_checkpoint_dir="hdfs://a/b/", spark_sql_warehouse_dir="file:/w")
    assert scratch_root(named) == "hdfs://a/b"
    assert scratch_root(_Session(spark_sql_warehouse_dir="file:/w/")) == "file:/w/_millrace_scratch"
