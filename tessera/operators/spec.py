"""Rule specs: decoding of rule logic (P20) and expansion of mappings into checks.

A *mapping* wires one catalog rule to one object column (or column list). A
custodial rule's logic is a JSON object ``{test_key: test_value, ...}``; each key
becomes one *check*. A row failing two checks of a mapping is reported twice.
A business rule's logic is a SQL SELECT returning the failing rows.
"""

from __future__ import annotations

import ast
import json
from dataclasses import dataclass, field
from typing import Any

from tessera.functions.projection import split_names

# The test-key vocabulary and its accepted spellings.
KEY_ALIASES = {
    "is_nullable": "is_nullable",
    "distinct": "distinct",
    "regex": "regex",
    "allowed": "allowed",
    "forbidden": "forbidden",
    "min": "min",
    "max": "max",
    "min_length": "min_length",
    "minlength": "min_length",
    "max_length": "max_length",
    "maxlength": "max_length",
    "min_date": "min_date",
    "mindate": "min_date",
    "min-date": "min_date",
    "max_date": "max_date",
    "maxdate": "max_date",
    "max-date": "max_date",
    "data_type": "data_type",
    "custom_sql": "custom_sql",
    "custom_spark": "custom_python",
    "custom_python": "custom_python",
}

ROW_KEYS = {"is_nullable", "regex", "min", "max", "min_length", "max_length", "min_date",
            "max_date", "allowed", "forbidden"}


class RuleDecodeError(ValueError):
    pass


@dataclass(frozen=True)
class Mapping:
    mapping_id: int
    rule_id: int
    object_id: int
    column_name: str
    rule_logic: str | None
    test_type: str = "Custodial"
    rule_description: str = ""
    object_name: str = ""
    primary_key: str = ""
    participating_table: str | None = None
    date_col: str | None = None

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(split_names(self.column_name))

    @property
    def is_business(self) -> bool:
        return (self.test_type or "").strip().lower() == "business"


@dataclass(frozen=True)
class Check:
    mapping: Mapping
    key: str
    value: Any = None
    columns: tuple[str, ...] = field(default_factory=tuple)

    @property
    def kind(self) -> str:
        if self.key == "business":
            return "business"
        if self.key in ("allowed", "forbidden") and isinstance(self.value, dict):
            return "lookup"
        if self.key in ROW_KEYS:
            return "row"
        return {"distinct": "key", "custom_sql": "sql", "custom_python": "python",
                "data_type": "schema"}[self.key]


@dataclass(frozen=True)
class RuleError:
    mapping: Mapping
    key: str
    error: str


def decode_rule_logic(text: str | dict | None) -> dict:
    """Strict JSON first, then a Python-literal reading (``'`` quotes, ``True``)."""
    if isinstance(text, dict):
        return text
    if text is None or not str(text).strip():
        return {}
    raw = str(text).strip()
    try:
        value = json.loads(raw)
    except json.JSONDecodeError:
        try:
            value = ast.literal_eval(raw)
        except (ValueError, SyntaxError):
            lenient = raw.replace("'", '"').replace("True", "true").replace("False", "false")
            try:
                value = json.loads(lenient)
            except json.JSONDecodeError as exc:
                raise RuleDecodeError(f"rule logic is neither JSON nor a literal dict: {exc}") from exc
    if not isinstance(value, dict):
        raise RuleDecodeError(f"rule logic must be an object, got {type(value).__name__}")
    return value


def canonical_logic(logic: dict) -> str:
    """Stable text of a custodial rule (sorted keys) used to find equal rules."""
    return json.dumps(logic, sort_keys=True)


def expand(mappings: list[Mapping]) -> tuple[list[Check], list[RuleError]]:
    checks: list[Check] = []
    errors: list[RuleError] = []
    for m in mappings:
        if m.is_business:
            if not m.rule_logic or not str(m.rule_logic).strip():
                errors.append(RuleError(m, "business", "empty business SQL"))
            else:
                checks.append(Check(m, "business", str(m.rule_logic), m.columns))
            continue
        try:
            logic = decode_rule_logic(m.rule_logic)
        except RuleDecodeError as exc:
            errors.append(RuleError(m, "rule_logic", str(exc)))
            continue
        if not logic:
            # An empty rule means "conform to the declared schema".
            checks.append(Check(m, "data_type", None, m.columns))
            continue
        for raw_key, value in logic.items():
            key = KEY_ALIASES.get(str(raw_key).strip().lower())
            if key is None:
                errors.append(RuleError(m, str(raw_key), "unknown test key"))
                continue
            if key == "is_nullable" and not (isinstance(value, str) and value.strip().upper() == "NO"
                                             or value is False):
                continue  # declared nullable: nothing to test
            if key == "distinct" and value not in (True, "true", "True", 1, "YES", "yes"):
                continue
            if key in ("custom_sql", "custom_python") and not isinstance(value, str):
                errors.append(RuleError(m, key, "value must be text"))
                continue
            if key in ROW_KEYS | {"distinct"} and not m.columns:
                errors.append(RuleError(m, key, "mapping names no column"))
                continue
            checks.append(Check(m, key, value, m.columns))
    return checks, errors
