"""The rule catalog as DataFrames, and the active rule plan.

The catalog is metadata: a few rows per rule, object and mapping. The plan is
built with joins over those frames and collected once per run (its size is the
catalog's, not the data's) to compile the rules of each object.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import schemas
from tessera.functions.local import local_frame
from tessera.operators.spec import Mapping

PLAN_COLUMNS = ["Object_ID", "Object_Name", "Object_Database_Name", "Object_Extension", "Primary_Key",
                "Validation_Period", "Time_Interval", "Validation_Frequency", "Mapping_ID", "Rule_ID",
                "Column_Name", "participating_table", "Source_Table_Date_Col", "Test_Type",
                "Rule_Description", "Rule_Logic"]


@dataclass
class Catalog:
    rule: DataFrame
    object_lookup: DataFrame
    rule_mapping: DataFrame
    rule_threshold: DataFrame
    handler: DataFrame
    distribution: DataFrame
    notification: DataFrame
    object_notification: DataFrame

    @staticmethod
    def from_rows(spark: SparkSession, rule=(), object_lookup=(), rule_mapping=(), rule_threshold=(),
                  handler=(), distribution=(), notification=(), object_notification=()) -> "Catalog":
        mk = lambda rows, schema: local_frame(spark, rows, schema)
        return Catalog(mk(rule, schemas.RULE), mk(object_lookup, schemas.OBJECT_LOOKUP),
                       mk(rule_mapping, schemas.RULE_MAPPING), mk(rule_threshold, schemas.RULE_THRESHOLD),
                       mk(handler, schemas.NOTIFICATION_HANDLER),
                       mk(distribution, schemas.NOTIFICATION_DISTRIBUTION),
                       mk(notification, schemas.NOTIFICATION), mk(object_notification, schemas.OBJECT_NOTIFICATION))

    @staticmethod
    def from_tables(spark: SparkSession, prefix: str = "") -> "Catalog":
        t = lambda n: spark.table(prefix + n)
        return Catalog(t("rule"), t("object_lookup"), t("rule_mapping"), t("rule_threshold"),
                       t("notification_message_handler"), t("notification_distribution_list"),
                       t("notification"), t("object_notification"))


def _active(df: DataFrame) -> DataFrame:
    return df.where(F.col("Active") == 1) if "Active" in df.columns else df


def rule_plan(catalog: Catalog, object_ids: list[int] | None = None, require_threshold: bool = True,
              database: str | None = None, object_name: str | None = None) -> DataFrame:
    """Active objects x active mappings x rules; J2: only mappings that have an
    active threshold (semi join replaces join + DISTINCT); A12: distinct rows."""
    objects = _active(catalog.object_lookup)
    if object_ids is not None:
        objects = objects.where(F.col("Object_ID").isin(list(object_ids)))
    if database is not None:
        objects = objects.where(F.col("Object_Database_Name") == database)
    if object_name is not None:
        objects = objects.where(F.col("Object_Name") == object_name)
    mappings = _active(catalog.rule_mapping).drop("Active").drop("Test_Type")
    # Catalog tables: a few rows per rule and object, broadcast.
    plan = (F.broadcast(objects.drop("Active"))
            .join(mappings, "Object_ID")
            .join(F.broadcast(catalog.rule), "Rule_ID"))
    if require_threshold:
        live = _active(catalog.rule_threshold).select("Mapping_ID")
        plan = plan.join(F.broadcast(live), "Mapping_ID", "left_semi")
    return plan.select(*PLAN_COLUMNS).distinct()


def check_database(plan_rows: list, requested: str) -> None:
    """The registered database of every planned object must be the requested one."""
    wrong = sorted({(r["Object_ID"], r["Object_Database_Name"]) for r in plan_rows
                    if r["Object_Database_Name"] != requested})
    if wrong:
        raise ValueError(f"objects registered under another database than {requested!r}: {wrong}")


@dataclass
class ObjectPlan:
    object_id: int
    object_name: str
    database: str | None
    extension: str | None
    primary_key: str
    validation_period: str | None
    time_interval: int | None
    date_col: str | None
    participating: list[str]
    mappings: list[Mapping]


def group_plan(rows: list) -> list[ObjectPlan]:
    """Collected plan rows -> one ``ObjectPlan`` per object, mappings in id order."""
    by_object: dict[int, list] = defaultdict(list)
    for r in rows:
        by_object[r["Object_ID"]].append(r)
    plans = []
    for oid in sorted(by_object):
        rs = sorted(by_object[oid], key=lambda r: r["Mapping_ID"])
        first = rs[0]
        date_cols = [r["Source_Table_Date_Col"] for r in rs if r["Source_Table_Date_Col"]]
        tables = []
        for r in rs:
            for t in (r["participating_table"] or "").split(","):
                if t.strip() and t.strip() not in tables:
                    tables.append(t.strip())
        mappings = [Mapping(r["Mapping_ID"], r["Rule_ID"], oid, r["Column_Name"], r["Rule_Logic"],
                            r["Test_Type"] or "Custodial", r["Rule_Description"] or "",
                            r["Object_Name"], r["Primary_Key"], r["participating_table"],
                            r["Source_Table_Date_Col"]) for r in rs]
        plans.append(ObjectPlan(oid, first["Object_Name"], first["Object_Database_Name"],
                                first["Object_Extension"], first["Primary_Key"] or "",
                                first["Validation_Period"], first["Time_Interval"],
                                date_cols[0] if date_cols else None, tables, mappings))
    return plans
