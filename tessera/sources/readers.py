"""Sources: table and file scans.

Window filters are built with literals of the column's own type, so the
comparison stays on the bare column and is pushed into the parquet/JDBC scan; text
columns are read as timestamps, since text order is not time order once days and
times mix. Windows are half-open: ``start <= c < end``.
"""

from __future__ import annotations

import csv
import datetime as dt

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.projection import split_names, ts_text
from tessera.operators.lookups import view_name

CORRUPT = "_corrupt_record"  # Spark's column for text it cannot read as JSON
FILE_FORMATS = ("csv", "json", "xml", "parquet", "orc")


def _window_value(df: DataFrame, column: str) -> tuple[Column, str]:
    """The column to compare and the type its bounds take."""
    dtype = next((f.dataType for f in df.schema.fields if f.name.lower() == column.lower()), None)
    if dtype is None:
        raise ValueError(f"window column {column!r} is not in the object")
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.col(column), dtype.simpleString()
    if isinstance(dtype, T.StringType):
        return F.try_to_timestamp(F.col(column)), "timestamp"
    raise ValueError(f"window column {column!r} is {dtype.simpleString()}, not a date, timestamp or text")


def windowed(df: DataFrame, column: str | None, start: dt.datetime | None,
             end: dt.datetime | None) -> DataFrame:
    """Rows with ``start <= column < end``; no column or no bounds = full table."""
    if not column or (start is None and end is None):
        return df
    value, kind = _window_value(df, column)
    bound = lambda at: F.lit(at.strftime("%Y-%m-%d") if kind == "date" else ts_text(at)).cast(kind)
    out = df
    if start is not None:
        out = out.where(value >= bound(start))
    if end is not None:
        out = out.where(value < bound(end))
    return out


def load_table(spark: SparkSession, name: str, fmt: str | None = None, path: str | None = None,
               date_col: str | None = None, start: dt.datetime | None = None,
               end: dt.datetime | None = None, options: dict | None = None) -> DataFrame:
    """A catalog table, or a path in any Spark format, optionally windowed."""
    if path:
        df = spark.read.format(fmt or "parquet").options(**(options or {})).load(path)
    else:
        df = spark.table(name)
    return windowed(df, date_col, start, end)


def register_tables(tables: dict[str, DataFrame]) -> dict[str, str]:
    """Register participating tables as views ``dataset_table`` (``.`` -> ``_``)."""
    names = {}
    for qualified, df in tables.items():
        name = view_name(qualified)
        df.createOrReplaceTempView(name)
        names[qualified] = name
    return names


def folder_tables(spark: SparkSession, folder: str, fmt: str = "parquet"):
    """``dataset.table`` -> the table of that name in a folder, as runs load objects and participating tables."""
    return lambda name: spark.read.format(fmt).load(f"{folder}/{name.split('.')[-1]}.{fmt}")


def participating(text: str | None) -> list[str]:
    """``'salesforce.orders,salesforce.customers'`` -> list; NULL means none."""
    return split_names(text)


def _first_line(spark: SparkSession, path: str) -> str | None:
    row = spark.read.text(path).limit(1).collect()
    return row[0][0] if row else None


def has_header(spark: SparkSession, path: str, expected: list[str] | None, sep: str = ",") -> bool:
    """A header is present when the first line names the expected columns.

    Without expected names, a first line whose fields are all non-numeric words
    counts as a header.
    """
    line = _first_line(spark, path)
    if line is None:
        return False
    fields = [f.strip() for f in next(csv.reader([line], delimiter=sep), [])]
    if expected:
        return [f.lower() for f in fields] == [e.lower() for e in expected] or (
            set(f.lower() for f in fields) >= set(e.lower() for e in expected))
    def numeric(text: str) -> bool:
        try:
            float(text)
            return True
        except ValueError:
            return False
    return all(f and not numeric(f) for f in fields)


def read_csv(spark: SparkSession, path: str, expected: list[str] | None = None,
             header: bool | None = None, schema: T.StructType | None = None) -> DataFrame:
    """CSV with header detection, ``"`` quote and escape, inferred types; a headerless
    file takes the expected column names in order. Where it has more columns, the rest keep
    Spark's ``_c<n>`` names, where it has fewer, the last names are absent: the schema check
    (S9) reports both.

    Inference reads the data once more; give ``schema`` when the types are known
    (large files), and the file is read only by the validation itself.
    """
    if header is None:
        header = has_header(spark, path, expected)
    reader = spark.read.option("header", header).option("quote", '"').option("escape", '"')
    if schema is not None:
        return reader.schema(schema).csv(path)
    df = reader.option("inferSchema", True).option("enforceSchema", False).csv(path)
    if not header and expected:
        df = df.toDF(*expected[:len(df.columns)], *df.columns[len(expected):])
    return df


def read_json(spark: SparkSession, path: str, multiline: bool = False,
              schema: T.StructType | None = None) -> DataFrame:
    """S7."""
    reader = spark.read.option("multiLine", multiline)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_xml(spark: SparkSession, path: str, row_tag: str = "row", schema: T.StructType | None = None) -> DataFrame:
    """Spark's built-in XML source."""
    reader = spark.read.format("xml").option("rowTag", row_tag)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_file(spark: SparkSession, path: str, extension: str | None = None,
              expected: list[str] | None = None, row_tag: str = "row",
              schema: T.StructType | None = None) -> DataFrame:
    ext = (extension or path.rsplit(".", 1)[-1]).lower()
    if ext == "csv":
        return read_csv(spark, path, expected, schema=schema)
    if ext in ("json", "jsonl", "ndjson"):
        return read_json(spark, path, schema=schema)
    if ext == "xml":
        return read_xml(spark, path, row_tag, schema=schema)
    if ext in ("parquet", "orc"):
        return spark.read.format(ext).load(path)
    raise ValueError(f"Unsupported file extension {ext!r}; expected one of csv, json, xml")


def load_sample(spark: SparkSession, path: str) -> DataFrame:
    """Sample reader chosen by extension (.csv, .json, .jsonl, .ndjson)."""
    lower = path.lower()
    if lower.endswith(".csv"):
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    if lower.endswith((".jsonl", ".ndjson")):
        return spark.read.json(path)
    if lower.endswith(".json"):
        by_line = spark.read.json(path)
        if CORRUPT not in by_line.columns:
            return by_line
        whole = spark.read.option("multiLine", True).json(path)  # one value over several lines
        return by_line if CORRUPT in whole.columns else whole
    raise ValueError(f"Unsupported sample data file extension for '{path}'. "
                     "Expected .csv, .json, or .jsonl.")


# ---- malformed records (S5, S7) -----------------------------------------------------------

SOURCE_FILE = "_source_file"


def with_corrupt(schema: T.StructType) -> T.StructType:
    """The schema with a column for records that do not fit it."""
    return schema if CORRUPT in schema.fieldNames() else T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])


def permissive(reader, schema: T.StructType):
    """A batch or stream reader that keeps the text of records it cannot read as the schema says."""
    return reader.schema(with_corrupt(schema)).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)


def well_formed(df: DataFrame) -> DataFrame:
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def malformed_findings(df: DataFrame, object_id: int, file_col: str = SOURCE_FILE) -> DataFrame:
    """S9 findings, one per file with malformed records: how many, and the first of them in text order."""
    found = df.where(F.col(CORRUPT).isNotNull()).groupBy(F.col(file_col).alias("_file")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.substring(CORRUPT, 1, 100)).alias("_first"))
    detail = F.concat(F.element_at(F.split("_file", "/"), -1), F.lit(": "), F.col("_n").cast("string"), F.lit(" record(s), first: "), F.col("_first"))
    return found.select(F.lit(object_id).cast("int").alias("Object_ID"), F.lit(None).cast("string").alias("Column_Name"),
                        F.lit("malformed").alias("Finding"), detail.alias("Detail"), "_file")


def read_with_findings(spark: SparkSession, path: str, extension: str, schema: T.StructType, object_id: int,
                       header: bool = False) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows, findings) of CSV or JSON files: records of another number of fields, values that are not of
    the declared type and broken JSON are findings, not rows. The files are read once: the read frame is held on the
    executors' disks for both (``unpersist`` the rows when done)."""
    if extension not in ("csv", "json"):
        raise ValueError(f"Unsupported file extension {extension!r}; expected csv or json")
    reader = permissive(spark.read, schema)
    if extension == "csv":
        reader = reader.option("header", header).option("quote", '"').option("escape", '"')
    df = reader.format(extension).load(path).withColumn(SOURCE_FILE, F.col("_metadata.file_path")).persist(StorageLevel.DISK_ONLY)
    return well_formed(df).drop(SOURCE_FILE), malformed_findings(df, object_id).drop("_file")
