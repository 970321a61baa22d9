"""tessera: a Spark-native data-quality rule engine.

Rules from a catalog are compiled into Spark plans: row-local tests fused into
one pass per object, key and lookup tests as aggregates and joins, SQL tests as
Spark SQL. Results are the detailed failures, one aggregate per rule mapping
with criticality, an object log, and rule errors.
"""

from tessera.clock import RunClock
from tessera.operators.spec import Check, Mapping, decode_rule_logic, expand
from tessera.plans.catalog import Catalog, rule_plan
from tessera.plans.engine import ObjectRun, ValidationResult, passing_rows, validate
from tessera.plans.runner import current_results, run

__all__ = ["RunClock", "Check", "Mapping", "decode_rule_logic", "expand", "ObjectRun",
           "ValidationResult", "passing_rows", "validate", "Catalog", "rule_plan", "run",
           "current_results"]
