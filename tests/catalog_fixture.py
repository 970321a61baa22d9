"""A catalog of our own: a lending library's members, loans, return slips (files), visits (hourly) and a closed branch."""

# (Rule_ID, description, logic, type)
RULES = [
    (2, "numbers are there", '{"is_nullable": "NO"}', "Custodial"),
    (3, "a number is given once", '{"distinct": true}', "Custodial"),
    (4, "card numbers are two letters and six digits", '{"regex": "^[A-Z]{2}[0-9]{6}$"}', "Custodial"),
    (6, "membership is of a known kind", '{"allowed": ["adult", "child", "staff"]}', "Custodial"),
    (8, "fines are not below zero", '{"min": 0}', "Custodial"),
    (9, "town names have three letters or more", '{"min_length": 3}', "Custodial"),
    (10, "nothing was lent before the library opened", '{"min_date": "1998-09-01"}', "Custodial"),
    (12, "nothing is lent tomorrow", '{"max_date": "CURRENT_DATE"}', "Custodial"),
    (13, "columns have their declared types", "{}", "Custodial"),
    (14, "staff pay no fines", '{"custom_sql": "SELECT * FROM dfSQL WHERE kind = \'staff\' AND fine > 0"}', "Custodial"),
]

# (Object_ID, name, database, extension, PK, period, interval, frequency, active)
OBJECTS = [
    (1, "members", "library", None, "member_no", "daily", None, "nightly", 1),
    (2, "loans", "library", None, "loan_no", "daily", None, "nightly", 1),
    (5, "returns", "library", "csv", "slip", "full table", None, "when a file comes", 1),
    (7, "visits", "doors", None, "visit_no", "daily", 60, "hourly", 1),
    (8, "branch_east", "library", None, "member_no", "daily", None, None, 0),
]

# (Mapping_ID, Object_ID, Rule_ID, Column_Name, participating_table, date col, type, active)
MAPPINGS = [
    (2, 1, 2, "member_no", None, None, "Custodial", 1),
    (3, 1, 3, "member_no", None, None, "Custodial", 1),
    (5, 1, 4, "card", None, None, "Custodial", 1),
    (6, 1, 6, "kind", None, None, "Custodial", 1),
    (8, 1, 9, "town", None, None, "Custodial", 1),
    (10, 2, 2, "loan_no", None, "lent_on", "Custodial", 1),
    (12, 2, 8, "fine", None, "lent_on", "Custodial", 1),
    (13, 2, 12, "lent_on", None, "lent_on", "Custodial", 1),
    (17, 5, 2, "slip", None, None, "Custodial", 1),
    (18, 5, 13, "slip", None, None, "Custodial", 1),
    (20, 7, 3, "visit_no", None, "seen_at", "Custodial", 1),
    (25, 7, 10, "seen_at", None, "seen_at", "Custodial", 0),
    (30, 8, 2, "member_no", None, None, "Custodial", 1),
]

# (Threshold_ID, Mapping_ID, value, criticality, active); mapping 12 has none.
THRESHOLDS = [(i, m, v, c, 1) for i, (m, v, c) in enumerate(
    [(2, 0.0, 2), (3, 0.0, 3), (5, 0.02, 1), (5, 0.2, 2), (6, 0.05, 1), (8, 0.1, 1), (10, 0.0, 2), (13, 0.0, 3), (17, 0.0, 3), (18, 0.0, 1),
     (20, 0.0, 2), (25, 0.0, 1), (30, 0.0, 3)], 1)]

# Alert routing with texts and contacts of our own.
HANDLERS = [(1, "note it"), (2, "look into it today"), (3, "wake somebody")]
DISTRIBUTION = [(1, "team@data.invalid"), (2, "lead@data.invalid"), (3, "oncall@data.invalid")]
NOTIFICATIONS = [(1, 1, 1), (2, 2, 2), (3, 3, 3)]
OBJECT_NOTIFICATIONS = [(1, 1, 1, 1), (2, 1, 2, 2), (3, 1, 3, 3), (4, 2, 1, 1), (5, 2, 2, 2), (6, 2, 3, 3),
                        (7, 5, 2, 2), (8, 5, 3, 3)]


def seed_catalog(spark):
    from decimal import Decimal

    from tessera.plans.catalog import Catalog
    return Catalog.from_rows(
        spark, rule=RULES, object_lookup=OBJECTS, rule_mapping=MAPPINGS,
        rule_threshold=[(t, m, Decimal(str(v)), c, a) for t, m, v, c, a in THRESHOLDS],
        handler=HANDLERS, distribution=DISTRIBUTION, notification=NOTIFICATIONS,
        object_notification=OBJECT_NOTIFICATIONS)
