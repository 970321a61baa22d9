"""Fixed schemas of the engine's outputs and of the rule catalog.

Column names of the result tables are kept as the reference's consumers know
them, so downstream reports keep working.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
TS, DATE = T.TimestampType(), T.DateType()


def _schema(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# ---- result tables -------------------------------------------------------------

DETAILED = _schema(
    ("Primary_Key_Value_s_", S), ("Actual_Value", S), ("Run_ID", I), ("Period", DATE),
    ("Object_ID", I), ("Rule_ID", I), ("Mapping_ID", I), ("Column_Name", S),
    ("Primary_Key_Column_s_", S), ("Last_Update_Date", TS),
)

AGGREGATED = _schema(
    ("Last_Update_Date", TS), ("Failure_Percent", D), ("Failure_Count", L), ("Column_Name", S),
    ("Mapping_ID", I), ("Rule_ID", I), ("Object_ID", I), ("Period", DATE), ("Run_ID", I),
    ("Criticality", I), ("Object_Name", S), ("Rule_Description", S),
)

OBJECT_LOG = _schema(
    ("Object_Log_ID", I), ("Period", DATE), ("Object_ID", I), ("Object_Name", S),
    ("Last_Update_Date", TS), ("val_st_dt", TS), ("val_end_dt", TS),
)

EXECUTION = _schema(
    ("Object_ID", I), ("Validation_Period", S), ("Validation_frequency", S), ("Run_Type", S),
    ("Prev_Val_St_Dt", TS), ("Prev_Val_End_Dt", TS), ("Curr_Val_St_Dt", TS), ("Curr_Val_End_Dt", TS),
    ("Next_Val_St_Dt", TS), ("Next_Val_End_Dt", TS), ("Val_Status", S), ("Last_Upd_Dt", TS),
    ("Run_Id", I), ("Job_Id", S),
)

# Rules that could not be evaluated (bad JSON, unknown key, bad regex, SQL error):
# reported, never dropped silently.
RULE_ERRORS = _schema(
    ("Object_ID", I), ("Mapping_ID", I), ("Rule_ID", I), ("Column_Name", S),
    ("Test_Key", S), ("Error", S),
)

SCHEMA_FINDINGS = _schema(
    ("Object_ID", I), ("Column_Name", S), ("Finding", S), ("Detail", S),
)

# Alerts and their recipients.
ALERTS = _schema(
    ("Column_Name", S), ("Rule_ID", I), ("Object_ID", I), ("Run_ID", I), ("Criticality", I), ("Object_Name", S),
    ("Rule_Description", S), ("Notification_Handler_Text", S),
)
RECIPIENTS = _schema(*[(f.name, f.dataType) for f in ALERTS.fields[:-1]], ("Notification_ID", I),
                     ("Notification_Handler_Text", S), ("Contact_email", S))

# Last committed attempts of object runs (see plans.commits).
COMMITS = _schema(("Period", DATE), ("Object_ID", I), ("Run_ID", I), ("Attempt", S), ("Seq", I), ("Committed_At", TS))


def _of_run(schema: T.StructType) -> T.StructType:
    """A result table's schema with the columns that name the object run."""
    named = {"Run_ID": I, "Period": DATE}
    return T.StructType(schema.fields + [T.StructField(n, t, True) for n, t in named.items() if n not in schema.fieldNames()])


# Result tables that are read through the commit log.
RESULTS = {"detailed": DETAILED, "aggregated": AGGREGATED, "object_log": _of_run(OBJECT_LOG), "rule_errors": _of_run(RULE_ERRORS),
           "schema_findings": _of_run(SCHEMA_FINDINGS), "alerts": _of_run(ALERTS), "alert_recipients": _of_run(RECIPIENTS)}

# ---- rule catalog ----------------------------------------------------------------

RULE = _schema(("Rule_ID", I), ("Rule_Description", S), ("Rule_Logic", S), ("Test_Type", S))

OBJECT_LOOKUP = _schema(
    ("Object_ID", I), ("Object_Name", S), ("Object_Database_Name", S), ("Object_Extension", S),
    ("Primary_Key", S), ("Validation_Period", S), ("Time_Interval", I),
    ("Validation_Frequency", S), ("Active", I),
)

RULE_MAPPING = _schema(
    ("Mapping_ID", I), ("Object_ID", I), ("Rule_ID", I), ("Column_Name", S),
    ("participating_table", S), ("Source_Table_Date_Col", S), ("Test_Type", S), ("Active", I),
)

RULE_THRESHOLD = T.StructType([
    T.StructField("Threshold_ID", I, True), T.StructField("Mapping_ID", I, True),
    T.StructField("Failure_Threshold_Value", T.DecimalType(5, 4), True),
    T.StructField("Criticality", I, True), T.StructField("Active", I, True),
])

NOTIFICATION_HANDLER = _schema(("Notification_Handler_ID", I), ("Notification_Handler_Text", S))
NOTIFICATION_DISTRIBUTION = _schema(
    ("Notification_Distribution_ID", I), ("Notification_Distribution_Contact", S))
NOTIFICATION = _schema(
    ("Notification_ID", I), ("Notification_Distribution_ID", I), ("Notification_Handler_ID", I))
OBJECT_NOTIFICATION = _schema(
    ("Object_Notification_ID", I), ("ObjectID", I), ("Notification_ID", I), ("Criticality", I))

# Declared (reference) schema of an object, as an information schema lists it.
DECLARED_SCHEMA = _schema(("column", S), ("data_type", S), ("is_nullable", S))
