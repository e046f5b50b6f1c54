"""File round trips, declared schemas, local rows and SQL binding."""

import os
import tempfile

from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from framewright.sources import files, local
from tests.conftest import SF001


def test_csv_round_trip_inferred_and_glob(spark):
    d = tempfile.mkdtemp(prefix="fw-csv-")
    nation = spark.read.parquet(f"{SF001}/nation.parquet")
    for day in range(3):
        files.write(nation.where(F.col("n_regionkey") == day).coalesce(1), os.path.join(d, f"day{day}"), "csv",
                    header=True)
    one = files.read_csv(spark, os.path.join(d, "day0"))
    assert dict(one.dtypes)["n_nationkey"] == "int"
    glob = files.read_csv(spark, os.path.join(d, "day*", "*.csv"))
    assert glob.count() == nation.where(F.col("n_regionkey") < 3).count()


def test_json_declared_schema_keeps_metadata(spark):
    d = tempfile.mkdtemp(prefix="fw-json-")
    p = os.path.join(d, "f.json")
    with open(p, "w") as fh:
        fh.write('{"ferry": "Tern", "harbour": null, "berths": 64}\n{"ferry": "Auk", "harbour": "Skerry", "berths": 9}\n')
    schema = StructType([StructField("berths", StringType(), False, metadata={"unit": "cabins", "checked": 1998}),
                         StructField("harbour", StringType(), True)])
    df = files.read_json(spark, p, schema)
    f = df.schema["berths"]
    assert f.nullable is True and f.metadata == {"unit": "cabins", "checked": 1998}
    assert [tuple(r) for r in df.orderBy("berths").collect()] == [("64", None), ("9", "Skerry")]
    assert dict(files.read_json(spark, p).dtypes)["berths"] == "bigint"


def test_parquet_and_local_sources(spark):
    assert files.read_parquet(spark, f"{SF001}/region.parquet").count() == 5
    assert local.number_range(spark, 500).agg(F.sum("number")).first()[0] == sum(range(500))
    schema = StructType([StructField("depth", LongType(), False), StructField("sample", StringType(), True)])
    df = local.rows_with_schema(spark, [Row(40, "silt"), Row(55, None)], schema)
    assert [r.sample for r in df.orderBy("depth").collect()] == ["silt", None] and df.schema["depth"].nullable is False
    t = local.tuples_named(spark, [(0, "a"), (1, "b")], ["id", "name"])
    assert t.columns == ["id", "name"]


def test_sql_binding(spark):
    df = spark.read.parquet(f"{SF001}/region.parquet")
    out = files.sql(spark, "SELECT r_name FROM {r} WHERE r_regionkey = :k", {"k": 2}, r=df)
    assert out.first().r_name == "ASIA"
    files.register_view(df, "fw_region")
    assert files.sql(spark, "SELECT count(*) AS n FROM FW_REGION").first().n == 5
