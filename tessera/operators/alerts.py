"""Alert routing as table jobs.

Aggregate rows with a criticality are joined to the routing catalog (object x
criticality -> notification -> handler text, distribution contact). The
routing catalog is a handful of rows; the joins run over the whole aggregate
frame at once instead of a lookup per row. Mail delivery is out of scope: the
alert and recipient frames are the output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALERT_COLUMNS = ["Column_Name", "Rule_ID", "Object_ID", "Run_ID", "Criticality", "Object_Name",
                 "Rule_Description"]


def routes(catalog) -> DataFrame:
    """(ObjectID, route criticality, Notification_ID, handler text, contact)."""
    # The routing catalog is a handful of rows per object: broadcast.
    return (catalog.object_notification.select("ObjectID", F.col("Criticality").alias("Route_Criticality"),
                                               "Notification_ID")
            .join(F.broadcast(catalog.notification), "Notification_ID", "left")
            .join(F.broadcast(catalog.handler), "Notification_Handler_ID", "left")
            .join(F.broadcast(catalog.distribution), "Notification_Distribution_ID", "left")
            .select("ObjectID", "Route_Criticality", "Notification_ID", "Notification_Handler_Text",
                    F.col("Notification_Distribution_Contact").alias("Contact_email")))


def _match(alerts: DataFrame, r: DataFrame, mode: str):
    same_object = alerts["Object_ID"] == r["ObjectID"]
    if mode == "min":  # a route fires for every criticality at or above its own
        return same_object & (r["Route_Criticality"] <= alerts["Criticality"])
    return same_object & (r["Route_Criticality"] == alerts["Criticality"])


def alert_rows(aggregated: DataFrame, catalog, mode: str = "equal") -> DataFrame:
    """One row per alerting aggregate and matching handler; rows without a
    route are kept with a NULL handler text."""
    alerts = aggregated.where(F.col("Criticality").isNotNull()).select(*ALERT_COLUMNS)
    r = F.broadcast(routes(catalog).select("ObjectID", "Route_Criticality", "Notification_Handler_Text").distinct())
    return (alerts.join(r, _match(alerts, r, mode), "left")
            .select(*ALERT_COLUMNS, "Notification_Handler_Text"))


def recipients(aggregated: DataFrame, catalog, mode: str = "equal") -> DataFrame:
    """Every contact routed for each alerting aggregate's object and criticality."""
    alerts = aggregated.where(F.col("Criticality").isNotNull()).select(*ALERT_COLUMNS)
    r = F.broadcast(routes(catalog))
    return (alerts.join(r, _match(alerts, r, mode), "inner")
            .select(*ALERT_COLUMNS, "Notification_ID", "Notification_Handler_Text", "Contact_email"))


def write_extracts(alerts: DataFrame, path: str, mode: str = "append") -> None:
    """Per-object CSV extracts of the alert rows."""
    alerts.write.mode(mode).partitionBy("Object_ID").option("header", True).csv(path)
