"""Declared-type conformance (P15): is a Spark column type acceptable for a declared type?"""

from __future__ import annotations

import re

# The declared warehouse type names and the Spark type strings each
# accepts, as the reference's compatibility matrix lists them.
STRICT_ACCEPTED = {
    "TIMESTAMP": ["timestamp", "date", "string"],
    "DATE": ["timestamp", "date", "string"],
    "TIME": ["timestamp", "date", "string"],
    "DATETIME": ["timestamp", "date", "string"],
    "STRING": ["timestamp", "date", "boolean", "float", "int", "tinyint", "smallint", "bigint",
               "double", "decimal(10,0)", "string"],
    "BYTES": ["string"],
    "BOOL": ["boolean", "string"],
    "FLOAT64": ["float", "int", "tinyint", "smallint", "bigint", "double", "decimal(10,0)", "string"],
    "INT64": ["int", "tinyint", "smallint", "bigint", "string"],
    "NUMERIC": ["float", "int", "tinyint", "smallint", "bigint", "double", "decimal(10,0)", "string"],
    "ARRAY": ["string"],
    "STRUCT": ["string"],
    "GEOGRAPHY": ["string"],
}

# Our relaxed matrix works on type families, so decimal(p,s), timestamp_ntz,
# binary and real array/struct columns are judged by what they are.
_EXTRA_FAMILIES = {"BYTES": ["binary"], "ARRAY": ["array"], "STRUCT": ["struct"]}


def family(spark_type: str) -> str:
    text = spark_type.strip().lower()
    head = re.split(r"[<(]", text, maxsplit=1)[0]
    return "timestamp" if head == "timestamp_ntz" else head


def declared_key(declared: str) -> str:
    head = re.split(r"[<(\s]", declared.strip(), maxsplit=1)[0].upper()
    return {"BOOLEAN": "BOOL", "INTEGER": "INT64", "INT": "INT64", "FLOAT": "FLOAT64",
            "BIGNUMERIC": "NUMERIC", "DECIMAL": "NUMERIC", "BIGDECIMAL": "NUMERIC"}.get(head, head)


def declared_parts(declared: str) -> list[tuple[str, str]]:
    """The fields of ``STRUCT<name type, ...>``, the unnamed element of ``ARRAY<type>``; none for other
    declarations and for what is no whole declaration."""
    text = declared.strip()
    head, opened, rest = text.partition("<")
    if not opened or not rest.endswith(">") or head.strip().upper() not in ("STRUCT", "ARRAY"):
        return []
    parts, depth, start = [], 0, 0
    inner = rest[:-1]
    for at, sign in enumerate(inner):
        depth += (sign in "<(") - (sign in ">)")
        if depth < 0:
            return []
        if sign == "," and depth == 0:
            parts.append(inner[start:at].strip())
            start = at + 1
    parts.append(inner[start:].strip())
    if depth or not all(parts):
        return []
    if head.strip().upper() == "ARRAY":
        return [("", parts[0])] if len(parts) == 1 else []
    named = [tuple(part.split(None, 1)) for part in parts]
    return [(n[0].rstrip(":").strip("`"), n[1]) for n in named] if all(len(n) == 2 for n in named) else []


def accepts(declared: str, spark_type: str, strict: bool = False) -> bool | None:
    """True/False, or None when the declared type is unknown (no verdict)."""
    key = declared_key(declared)
    if key not in STRICT_ACCEPTED:
        return None
    if strict:
        return spark_type in STRICT_ACCEPTED[key]
    allowed = {family(t) for t in STRICT_ACCEPTED[key]} | set(_EXTRA_FAMILIES.get(key, []))
    return family(spark_type) in allowed


# Fixed value: the message's wording.
def mismatch_message(column: str, spark_type: str, declared: str) -> str:
    return f"{column} detected as {spark_type} type. Schema specifies {declared} type."


def missing_message(path: str, declared: str) -> str:
    return f"{path} is missing. Schema specifies {declared} type."
