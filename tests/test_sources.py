"""Sources and sinks (S1, S2, S4-S8, S10-S12) and file-name rules."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tessera.functions.paths import table_id
from tessera.sources import jdbc, readers, sinks
from tests.conftest import SF001


def test_window_is_half_open_and_pushed_down(spark):
    events = spark.read.parquet(f"{SF001}/events.parquet")
    w = readers.windowed(events, "ts", dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3))
    plan = w._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    ts = [r[0] for r in w.select("ts").collect()]
    assert ts and all(dt.datetime(2024, 1, 2) <= t < dt.datetime(2024, 1, 3) for t in ts)


def test_csv_header_detection_and_headerless_names(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "with.csv"), "w") as f:
        f.write('Id,Name,Score\n1,"Ann, A",2.5\n2,Bo,3\n')
    with open(os.path.join(tmp_dir, "without.csv"), "w") as f:
        f.write('1,"Ann ""A""",2.5\n2,Bo,3\n')
    a = readers.read_csv(spark, os.path.join(tmp_dir, "with.csv"), ["Id", "Name", "Score"])
    b = readers.read_csv(spark, os.path.join(tmp_dir, "without.csv"), ["Id", "Name", "Score"])
    assert a.columns == b.columns == ["Id", "Name", "Score"]
    assert a.collect()[0]["Name"] == "Ann, A" and b.collect()[0]["Name"] == 'Ann "A"'
    assert dict(a.dtypes)["Score"] == "double" and dict(b.dtypes)["Id"] == "int"


def test_json_xml_and_sample_reader(spark, tmp_dir):
    jl = os.path.join(tmp_dir, "t.jsonl")
    with open(jl, "w") as f:
        f.write('{"id": 1, "v": "a"}\n{"id": 2, "v": null}\n')
    arr = os.path.join(tmp_dir, "t.json")
    with open(arr, "w") as f:
        f.write('[{"id": 1}, {"id": 2}, {"id": 3}]')
    xml = os.path.join(tmp_dir, "t.xml")
    with open(xml, "w") as f:
        f.write("<rows><row><id>1</id><v>a</v></row><row><id>2</id><v>b</v></row></rows>")
    assert readers.read_file(spark, jl).count() == 2
    assert readers.load_sample(spark, arr).count() == 3
    assert readers.read_file(spark, xml, row_tag="row").count() == 2
    with pytest.raises(ValueError):
        readers.load_sample(spark, os.path.join(tmp_dir, "t.parquet.gz"))


def test_register_participating_tables(spark):
    df = spark.createDataFrame([(1,)], "x int")
    names = readers.register_tables({"salesforce.orders": df, "proj.sales.items": df})
    assert names == {"salesforce.orders": "salesforce_orders", "proj.sales.items": "sales_items"}
    assert spark.table("sales_items").count() == 1
    assert readers.participating(None) == [] and readers.participating("a.b,c.d") == ["a.b", "c.d"]


def test_jdbc_options_window_and_partitions():
    opts = jdbc.jdbc_options("jdbc:mysql://h/db", "products", "u", "p", date_col="updated",
                             start=dt.datetime(2024, 1, 1), end=dt.datetime(2024, 1, 2),
                             partition_column="product_id", lower_bound=1, upper_bound=1000, num_partitions=8)
    assert opts["dbtable"] == ("(SELECT * FROM products WHERE updated >= '2024-01-01 00:00:00' AND "
                               "updated < '2024-01-02 00:00:00') src")
    assert (opts["partitionColumn"], opts["numPartitions"]) == ("product_id", "8")
    assert jdbc.jdbc_options("jdbc:x", "t")["dbtable"] == "t"
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x", "t", partition_column="id")


def test_sink_round_trip_partitioned(spark, tmp_dir):
    df = spark.createDataFrame([(1, dt.date(2024, 6, 1)), (2, dt.date(2024, 6, 2))], "x int, Period date")
    sinks.write_results(df, f"{tmp_dir}/out")
    sinks.write_results(df, f"{tmp_dir}/out")
    back = spark.read.parquet(f"{tmp_dir}/out")
    assert back.count() == 4 and os.path.isdir(f"{tmp_dir}/out/Period=2024-06-01")


def test_table_id_from_path(spark):
    df = spark.createDataFrame([("gs://b/in/account.csv",), ("/x/y/transaction.json",), ("plain",),
                                ("/a/b.c/d.tar.gz",)], "p string")
    assert [r[0] for r in df.select(table_id(F.col("p"))).collect()] == ["account", "transaction", "plain", "d.tar"]


def test_load_table_from_path_with_window(spark):
    df = readers.load_table(spark, "orders", fmt="parquet", path=f"{SF001}/orders.parquet",
                            date_col="o_orderdate", start=dt.datetime(1996, 1, 1), end=dt.datetime(1997, 1, 1))
    dates = [r[0] for r in df.select("o_orderdate").collect()]
    assert dates and all(dt.datetime(1996, 1, 1) <= d < dt.datetime(1997, 1, 1) for d in dates)


def test_declared_frame_and_empty_execution(spark):
    from tessera import schemas
    from tessera.operators.schema_check import declared_frame, declared_list
    from tessera.plans.runner import empty_execution
    decl = [("a", "INT64", "NO"), ("b", "STRING", None)]
    assert declared_list(declared_frame(spark, decl)) == decl
    empty = empty_execution(spark)
    assert empty.count() == 0 and [f.name for f in empty.schema.fields] == [f.name for f in schemas.EXECUTION.fields]


def test_window_on_a_missing_column_is_a_clear_error(spark):
    events = spark.read.parquet(f"{SF001}/events.parquet")
    with pytest.raises(ValueError, match="not in the object"):
        readers.windowed(events, "event_time", dt.datetime(2024, 1, 1), None)


def test_csv_with_known_schema_and_window_on_numbers(spark, tmp_dir):
    path = os.path.join(tmp_dir, "k.csv")
    with open(path, "w") as f:
        f.write("Id,Name\n1,a\n2,b\n")
    df = readers.read_csv(spark, path, ["Id", "Name"], schema=spark.createDataFrame([], "Id long, Name string").schema)
    assert dict(df.dtypes) == {"Id": "bigint", "Name": "string"} and df.count() == 2
    with pytest.raises(ValueError, match="not a date"):
        readers.windowed(df, "Id", dt.datetime(2024, 1, 1), None)


def test_text_dates_are_compared_as_times(spark):
    df = spark.createDataFrame([(x,) for x in ("2024-01-14", "2024-01-15", "2024-01-15 23:59:59", "2024-01-16",
                                               "2024-01-15T10:00:00", "not a date", None)], "d string")
    got = {r.d for r in readers.windowed(df, "d", dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 16)).collect()}
    assert got == {"2024-01-15", "2024-01-15 23:59:59", "2024-01-15T10:00:00"}


def test_quoted_header_and_uneven_columns(spark, tmp_dir):
    path = os.path.join(tmp_dir, "quoted.csv")
    with open(path, "w") as f:
        f.write('"Id","Name, full","Score"\n1,"Ann, A",2.5\n')
    assert readers.read_csv(spark, path, ["Id", "Name, full", "Score"]).columns == ["Id", "Name, full", "Score"]
    bare = os.path.join(tmp_dir, "bare.csv")
    with open(bare, "w") as f:
        f.write("1,a,x\n2,b,y\n")
    assert readers.read_csv(spark, bare, ["Id", "Name"], header=False).columns == ["Id", "Name", "_c2"]
    assert readers.read_csv(spark, bare, ["Id", "Name", "Code", "More"], header=False).columns == ["Id", "Name", "Code"]


def test_pretty_printed_json_object(spark, tmp_dir):
    path = os.path.join(tmp_dir, "one.json")
    with open(path, "w") as f:
        f.write('{\n  "id": 1,\n  "v": "a"\n}\n')
    rows = readers.load_sample(spark, path).collect()
    assert [(r.id, r.v) for r in rows] == [(1, "a")]
    lines = os.path.join(tmp_dir, "lines.json")
    with open(lines, "w") as f:
        f.write('{"id": 1}\n{"id": 2}\n')
    assert readers.load_sample(spark, lines).count() == 2


def test_jdbc_reads_are_split_by_key(spark):
    """A stand-in for the driver's load: no database may be started here."""
    asked = []

    def load(spark, options):
        asked.append(options)
        return spark.createDataFrame([(5, 104)], "lo int, hi int") if "MIN(" in options["dbtable"] else spark.range(1)

    opts = jdbc.jdbc_options("jdbc:x", "products", date_col="updated", start=dt.datetime(2024, 1, 1), end=None)
    jdbc.read_jdbc(spark, opts, key="id", load=load)
    assert asked[0]["dbtable"].startswith("(SELECT MIN(id) AS lo, MAX(id) AS hi FROM (SELECT * FROM products WHERE")
    assert (asked[1]["lowerBound"], asked[1]["upperBound"]) == ("5", "105") and int(asked[1]["numPartitions"]) >= 1
    assert jdbc.with_bounds({"dbtable": "t"}, "id", (None, None), 8) == {"dbtable": "t"}
