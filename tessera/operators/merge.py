"""Merge of reviewed candidate rules into the catalog.

Candidate rows: ``rule_id_temp, test_type, column_name, rule_description,
rule_logic, confidence, include``. Admission (C1) marks each row with a reject
reason; admitted rows equal to an existing mapping of the object (same column,
same canonical logic, same type) are skipped unless ``force`` (C2, J9); the
object is looked up or created without overwriting its primary key (C3); new
ids continue the catalog's (C4); every new mapping gets a default threshold (C5).
Equal rules within a batch count once, like rules the catalog already holds.
``append`` gives the catalog with a merge applied.
"""

from __future__ import annotations

import json
import sys
from dataclasses import dataclass, replace

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.local import local_frame
from tessera.operators import spec as _spec
from tessera.operators.spec import canonical_logic, decode_rule_logic

# The two UDFs below run on executors. Their code (and the rule decoding they
# call) is shipped by value with the task, so workers need not import this
# package from their own path.
cloudpickle.register_pickle_by_value(_spec)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The proposable key vocabulary (no custom code), the hard
# constraints, and their default thresholds.
PROPOSABLE_KEYS = ["is_nullable", "distinct", "regex", "allowed", "forbidden", "min", "max",
                   "min_length", "max_length", "min_date", "max_date", "data_type", "custom_sql"]
HARD_KEYS = ["is_nullable", "distinct", "data_type"]
HARD_DEFAULT = (0.0, 3)
SOFT_DEFAULT = (0.01, 2)
DESCRIPTION_LIMIT = 500


@F.pandas_udf(T.StringType())
def canonical_logic_udf(logic: pd.Series, test_type: pd.Series) -> pd.Series:
    """Sorted-key JSON for custodial logic; business SQL as written. NULL if unreadable."""
    def one(text, kind):
        if text is None:
            return None
        if str(kind).lower() == "business":
            return str(text)
        try:
            return canonical_logic(decode_rule_logic(text))
        except ValueError:
            return None
    return pd.Series([one(t, k) for t, k in zip(logic, test_type)], dtype=object)


@F.pandas_udf(T.ArrayType(T.StringType()))
def logic_keys_udf(logic: pd.Series) -> pd.Series:
    def one(text):
        try:
            return sorted(json.loads(text).keys()) if text else []
        except (ValueError, AttributeError):
            return None
    return pd.Series([one(t) for t in logic], dtype=object)


def admit(candidates: DataFrame) -> DataFrame:
    """Adds ``canonical`` and ``reject_reason`` (NULL = admitted)."""
    c = candidates.withColumn("canonical", canonical_logic_udf("rule_logic", "test_type"))
    c = c.withColumn("_keys", F.when(F.lower("test_type") == "custodial", logic_keys_udf("canonical")))
    vocab = F.array(*[F.lit(k) for k in PROPOSABLE_KEYS])
    reason = (F.when(~F.col("test_type").isin("Custodial", "Business"), "unknown test type")
              .when(F.col("confidence").isNull() | (F.col("confidence") < 0) | (F.col("confidence") > 1),
                    "confidence outside [0, 1]")
              .when(F.length("rule_description") > DESCRIPTION_LIMIT, "description longer than 500")
              .when(F.col("column_name").isNull() | (F.trim("column_name") == ""), "no column")
              .when(F.col("canonical").isNull() | (F.trim("canonical") == ""), "unreadable or empty logic")
              .when((F.col("test_type") == "Custodial") & (F.size("_keys") == 0), "no constraint")
              .when((F.col("test_type") == "Custodial") & (F.size(F.array_except("_keys", vocab)) > 0),
                    "key outside the rule vocabulary"))
    return c.withColumn("reject_reason", reason)


@dataclass
class MergeResult:
    object_id: DataFrame
    rules: DataFrame
    mappings: DataFrame
    thresholds: DataFrame
    skipped: DataFrame
    rejected: DataFrame
    key_conflicts: DataFrame


def _max_id(df: DataFrame, column: str) -> int:
    """Largest id of a catalog table (a scalar; catalogs are small)."""
    value = df.agg(F.max(column)).first()[0]
    return int(value) if value is not None else 0


def resolve_object(spark: SparkSession, catalog, object_name: str, database: str, primary_key: str,
                   extension: str | None = None, period: str = "full table") -> tuple[DataFrame, DataFrame]:
    """(object row to use, existing object rows whose primary key differs)."""
    wanted = local_frame(spark, [(object_name, database, primary_key, extension, period)],
                                   "Object_Name string, Object_Database_Name string, Primary_Key string, "
                                   "Object_Extension string, Validation_Period string")
    objects = catalog.object_lookup
    existing = objects.join(wanted.select("Object_Name", "Object_Database_Name"),
                            ["Object_Name", "Object_Database_Name"], "left_semi")
    next_id = _max_id(objects, "Object_ID") + 1
    created = (wanted.join(existing, ["Object_Name", "Object_Database_Name"], "left_anti")
               .select(F.lit(next_id).cast("int").alias("Object_ID"), "Object_Name",
                       "Object_Database_Name", "Object_Extension", "Primary_Key", "Validation_Period",
                       F.lit(None).cast("int").alias("Time_Interval"),
                       F.lit(None).cast("string").alias("Validation_Frequency"), F.lit(1).alias("Active")))
    chosen = existing.select(*created.columns).unionByName(created)
    conflicts = (existing.join(wanted.select("Object_Name", "Object_Database_Name",
                                             F.col("Primary_Key").alias("_proposed")),
                               ["Object_Name", "Object_Database_Name"])
                 .where(F.col("Primary_Key").isNotNull() & F.col("_proposed").isNotNull()
                        & (F.col("Primary_Key") != F.col("_proposed")))
                 .select("Object_ID", "Primary_Key", "_proposed"))
    return chosen, conflicts


def _numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``_n`` = 1, 2, ... in the given order. The full candidate key orders ties, so the numbers are the same
    wherever they are asked for. One window over all rows: these are the rules a merge adds to the catalog,
    which its readers hold whole."""
    return df.withColumn("_n", F.row_number().over(Window.orderBy(*order)).cast("long"))


def append(catalog, result: MergeResult):
    """The catalog with a merge's object, rules, mappings and thresholds added (C2's last step)."""
    fits = lambda table, rows: table.unionByName(rows.select(
        *[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in table.schema.fields]))
    objects = catalog.object_lookup
    new = result.object_id.join(objects.select("Object_ID"), "Object_ID", "left_anti")
    return replace(catalog, object_lookup=fits(objects, new), rule=fits(catalog.rule, result.rules),
                   rule_mapping=fits(catalog.rule_mapping, result.mappings),
                   rule_threshold=fits(catalog.rule_threshold, result.thresholds))


def merge(spark: SparkSession, catalog, candidates: DataFrame, object_name: str, database: str,
          primary_key: str, force: bool = False, skip_thresholds: bool = False) -> MergeResult:
    obj, conflicts = resolve_object(spark, catalog, object_name, database, primary_key)
    target = obj.select("Object_ID").first()  # O5: the one object row
    oid = int(target[0])
    checked = admit(candidates.where(F.coalesce(F.col("include"), F.lit(True))))
    rejected = checked.where(F.col("reject_reason").isNotNull())
    admitted = (checked.where(F.col("reject_reason").isNull())
                .withColumn("Target_Object_ID", F.lit(oid).cast("int")))

    # Existing (object, column, canonical logic, type) of the catalog.
    existing = (catalog.rule_mapping.join(catalog.rule.select("Rule_ID", "Rule_Logic", F.col("Test_Type").alias("_rt")),
                                          "Rule_ID")
                .select(F.col("Object_ID").alias("Target_Object_ID"), F.col("Column_Name").alias("column_name"),
                        canonical_logic_udf("Rule_Logic", "_rt").alias("canonical"),
                        F.col("_rt").alias("test_type")))
    keys = ["Target_Object_ID", "column_name", "canonical", "test_type"]
    # One row per rule of the batch: of equal ones the first by its temporary id.
    rest = [c for c in admitted.columns if c not in keys]
    if force:
        fresh, skipped = admitted, admitted.limit(0)
    else:
        single = (admitted.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct("rule_id_temp", "rule_description")).alias("_r"))
                  .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]))
        fresh = single.join(existing, keys, "left_anti")
        skipped = admitted.join(existing.select(*keys).distinct(), keys, "left_semi")

    max_rule = _max_id(catalog.rule, "Rule_ID")
    max_map = _max_id(catalog.rule_mapping, "Mapping_ID")
    max_thr = _max_id(catalog.rule_threshold, "Threshold_ID")
    numbered = (_numbered(fresh, ["rule_id_temp", *keys, "rule_description"])
                .withColumn("Rule_ID", (F.lit(max_rule) + F.col("_n")).cast("int"))
                .withColumn("Mapping_ID", (F.lit(max_map) + F.col("_n")).cast("int"))
                .withColumn("Threshold_ID", (F.lit(max_thr) + F.col("_n")).cast("int")))
    rules = numbered.select("Rule_ID", "rule_description", F.col("canonical").alias("Rule_Logic"),
                            "test_type").toDF("Rule_ID", "Rule_Description", "Rule_Logic", "Test_Type")
    mappings = numbered.select("Mapping_ID", F.col("Target_Object_ID").cast("int").alias("Object_ID"), "Rule_ID",
                               F.col("column_name").alias("Column_Name"),
                               F.lit(None).cast("string").alias("participating_table"),
                               F.lit(None).cast("string").alias("Source_Table_Date_Col"),
                               F.col("test_type").alias("Test_Type"), F.lit(1).alias("Active"))
    hard = (F.col("test_type") == "Custodial") & (F.size(F.array_intersect(
        "_keys", F.array(*[F.lit(k) for k in HARD_KEYS]))) > 0)
    thresholds = numbered.select(
        "Threshold_ID", "Mapping_ID",
        F.when(hard, F.lit(HARD_DEFAULT[0])).otherwise(F.lit(SOFT_DEFAULT[0])).cast("decimal(5,4)")
        .alias("Failure_Threshold_Value"),
        F.when(hard, F.lit(HARD_DEFAULT[1])).otherwise(F.lit(SOFT_DEFAULT[1])).cast("int").alias("Criticality"),
        F.lit(1).alias("Active"))
    if skip_thresholds:
        thresholds = thresholds.limit(0)
    return MergeResult(obj, rules, mappings, thresholds, skipped, rejected, conflicts)
