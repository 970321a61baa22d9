"""Catalog-sized frames as local relations.

``createDataFrame`` on a Python list builds an RDD scan whose size Spark does
not know, so every join against it costs a job or a shuffle. Small metadata
frames (mapping metadata, thresholds, rule errors, findings) are handed over as
an Arrow table instead: Spark keeps it as a local relation, whose size the
planner sees, up to ``spark.sql.execution.arrow.localRelationThreshold`` and
distributes it beyond. One path and one coercion for any number of rows.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def _schema(schema: T.StructType | str) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    return T._parse_datatype_string(schema)  # needs an active session


def _value(value, dtype: T.DataType):
    """A catalog value as the column's type; naive times are UTC, like the session."""
    if value is None:
        return None
    if isinstance(dtype, T.StringType):
        return str(value)
    if isinstance(dtype, T.BooleanType):
        return bool(value)
    if isinstance(dtype, T.BinaryType):
        return bytes(value)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return float(value)
    if isinstance(dtype, T.DecimalType):
        return Decimal(str(value)).quantize(Decimal(1).scaleb(-dtype.scale))
    if isinstance(dtype, T.IntegralType):
        return int(value)
    if isinstance(dtype, T.TimestampNTZType):
        return value if isinstance(value, dt.datetime) else dt.datetime.fromisoformat(str(value))
    if isinstance(dtype, T.TimestampType):
        at = value if isinstance(value, dt.datetime) else dt.datetime.fromisoformat(str(value))
        return at if at.tzinfo else at.replace(tzinfo=dt.timezone.utc)
    if isinstance(dtype, T.DateType):
        if isinstance(value, dt.datetime):
            return value.date()
        return value if isinstance(value, dt.date) else dt.date.fromisoformat(str(value))
    if isinstance(dtype, T.ArrayType):
        return [_value(x, dtype.elementType) for x in value]
    raise TypeError(f"unsupported catalog value {value!r} for {dtype.simpleString()}")


def local_frame(spark: SparkSession, rows, schema: T.StructType | str) -> DataFrame:
    struct = _schema(schema)
    rows = [tuple(r) for r in rows]
    for r in rows:
        if len(r) != len(struct.fields):
            raise ValueError(f"row {r!r} does not match schema {struct.simpleString()}")
    arrow = [to_arrow_type(f.dataType) for f in struct.fields]
    columns = [pa.array([_value(r[i], f.dataType) for r in rows], arrow[i]) for i, f in enumerate(struct.fields)]
    # Renamed last, so a schema may repeat a name.
    numbered = pa.Table.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])
    wide = T.StructType([T.StructField(f"c{i}", f.dataType, True) for i, f in enumerate(struct.fields)])
    return spark.createDataFrame(numbered, wide).toDF(*struct.names)
