"""Text placed into SQL expressions reads back unchanged under either escape setting."""

import pytest

from tessera.functions.local import local_frame
from tessera.functions.projection import joined_text_sql, sql_string

VALUES = ["plain", "it's", "a\\b\\\\c", "^[a-z]+\\.com$", "'lead", "trail'", "x''y", "", 'ünï"q"']


@pytest.mark.parametrize("flag", ["false", "true"])
def test_sql_string_round_trip(spark, flag):
    old = spark.conf.get("spark.sql.parser.escapedStringLiterals", "false")
    spark.conf.set("spark.sql.parser.escapedStringLiterals", flag)
    try:
        got = [spark.sql("SELECT " + sql_string(v)).first()[0] for v in VALUES]
        frame = local_frame(spark, [(i, v) for i, v in enumerate(VALUES)], "i int, v string")
        back = [r["v"] for r in frame.orderBy("i").collect()]
    finally:
        spark.conf.set("spark.sql.parser.escapedStringLiterals", old)
    assert got == VALUES and back == VALUES


def test_joined_text_sql_quotes_names(spark):
    df = spark.createDataFrame([(1, "x")], "`a b` int, `c``d` string")
    assert df.selectExpr(joined_text_sql(["a b", "c`d"])).first()[0] == "1, x"
