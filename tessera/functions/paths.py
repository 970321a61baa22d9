"""File-name helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The table id of an arriving file is the text between the last '/' and the last '.'.
TABLE_ID_PATTERN = r"([^/]*)\.[^./]*$"


def table_id(path: Column) -> Column:
    """``gs://bucket/in/account.csv`` -> ``account``; a name without extension -> itself."""
    stem = F.regexp_extract(path, TABLE_ID_PATTERN, 1)
    base = F.regexp_extract(path, r"([^/]*)$", 1)
    return F.when(stem != "", stem).otherwise(base)


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([^./]*)$", 1))
