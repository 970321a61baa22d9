"""Tiny hand-made frames named after the objects the catalog seeds talk about."""

import datetime as dt

from tessera.clock import RunClock
from tessera.operators.spec import Mapping

CLOCK = RunClock.fixed("2024-06-01 12:00:00")

CUSTOMERS = [  # customer_id, region, email, status, name, signup (text), score
    (1, "EU", "a@x.com", "Active", "Ann", "2021-03-04", 10.0),
    (2, "EU", "bad-email", "Active", "Bo", "2019-12-31", 100.0),        # bad e-mail, old date, boundary max
    (3, None, "c@x.com", "Deleted", "C", "not a date", -1.0),           # NULL key part, bad status, short name
    (3, "US", None, None, None, None, None),                             # duplicate id, NULLs
    (None, "US", "e@x.com", "Pending", "Eve", "2024-07-01", 100.5),     # NULL id, future date, above max
    (6, "US", "f@x.com", "Closed", "Fay", "2020-01-01", 0.0),           # boundary min and min_date
]
CUSTOMER_SCHEMA = ("customer_id int, region string, email string, status string, name string, "
                   "signup string, score double")

ORDERS = [  # order_id, customer_id, order_date, amount
    (10, 1, dt.datetime(2024, 5, 31, 23, 0), 5.0),
    (11, 2, dt.datetime(2024, 6, 1, 8, 0), -3.0),
    (12, 9, dt.datetime(2024, 6, 2, 0, 0), 7.0),
    (12, None, None, None),
]
ORDERS_SCHEMA = "order_id int, customer_id int, order_date timestamp, amount double"


def customers(spark):
    return spark.createDataFrame(CUSTOMERS, CUSTOMER_SCHEMA)


def orders(spark):
    return spark.createDataFrame(ORDERS, ORDERS_SCHEMA)


def mapping(mid, column, logic, rule_id=None, test_type="Custodial", object_id=1, pk="customer_id",
            name="customers"):
    return Mapping(mid, rule_id or mid, object_id, column, logic, test_type, f"rule {mid}", name, pk)
