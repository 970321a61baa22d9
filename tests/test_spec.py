"""Rule decoding (P20) and expansion of mappings into checks (P19 dispatch)."""

import pytest

from tessera.operators.spec import (Mapping, RuleDecodeError, canonical_logic, decode_rule_logic,
                                    expand)


def m(logic, column="c", test_type="Custodial", mid=1):
    return Mapping(mid, 1, 1, column, logic, test_type)


def test_strict_json_first():
    assert decode_rule_logic('{"regex": "^a\'b$"}') == {"regex": "^a'b$"}


def test_lenient_python_literal_and_quotes():
    assert decode_rule_logic("{'distinct': True}") == {"distinct": True}
    assert decode_rule_logic("{'distinct': true}") == {"distinct": True}


def test_undecodable_is_an_error_not_dropped():
    with pytest.raises(RuleDecodeError):
        decode_rule_logic("{distinct true")
    checks, errors = expand([m("{distinct true")])
    assert not checks and errors[0].key == "rule_logic"


def test_aliases_resolve_to_canonical_keys():
    checks, errors = expand([m('{"minlength": 2, "max-date": "2020-01-01", "mindate": "2000-01-01"}')])
    assert [c.key for c in checks] == ["min_length", "max_date", "min_date"] and not errors


def test_unknown_key_is_reported():
    checks, errors = expand([m('{"minimum_value": 3}')])
    assert not checks and errors[0].error == "unknown test key"


def test_nullable_yes_and_distinct_false_test_nothing():
    checks, errors = expand([m('{"is_nullable": "YES"}'), m('{"distinct": false}', mid=2)])
    assert checks == [] and errors == []


def test_empty_rule_means_schema_conformance():
    checks, _ = expand([m("{}")])
    assert checks[0].key == "data_type" and checks[0].kind == "schema"


def test_kinds():
    checks, _ = expand([m('{"allowed": ["a"], "forbidden": {"table_name": "t", "column_name": "x"}, '
                          '"distinct": true, "custom_sql": "SELECT 1", "custom_spark": "f"}')])
    assert [c.kind for c in checks] == ["row", "lookup", "key", "sql", "python"]


def test_business_rule_keeps_sql():
    checks, _ = expand([m("SELECT * FROM t;", column="a, b", test_type="Business")])
    assert checks[0].kind == "business" and checks[0].columns == ("a", "b")


def test_column_list_split_on_comma_with_or_without_space():
    assert m("{}", column="a,b").columns == ("a", "b") == m("{}", column="a, b").columns


def test_canonical_logic_sorts_keys():
    assert canonical_logic({"max": 1, "min": 0}) == canonical_logic({"min": 0, "max": 1})
