import pytest
from pyspark.sql import functions as F

from staytally import SnapshotError
from staytally.functions import strict_json as J


def _accepted(spark, bodies, form="string"):
    frame = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], f"i int, body {form}")
    parsed = J.with_strict_json(frame, "body", "doc").select("i", F.col("doc").isNotNull().alias("ok"))
    return [r.ok for r in sorted(parsed.collect())]


def test_one_document_is_accepted(spark):
    bodies = ["{}", "[]", "null", "3", '"x"', ' {"a": [1, {"b": null}]}\n', '{"a": "\\u00e9]"}']
    assert _accepted(spark, bodies) == [True] * len(bodies)


def test_anything_else_is_refused(spark):
    bodies = [
        "", " ", "{", '{"a": 1, "a": 2}', '{"x": {"a": 1, "a": 1}}', '{"x": NaN}',
        '{"x": Infinity}', '{"x": -Infinity}', '{"a": 1} x', "{} {}", "1, 2", "1], [2", "1]", "]",
        "[1", "{'a': 1}", "01", "+1", ".5", "1.", "// c\n1", '"\x01"', "﻿{}", "nul", None,
    ]
    assert _accepted(spark, bodies) == [False] * len(bodies)


def test_lenient_sessions_are_refused(spark):
    name = "spark.sql.variant.allowDuplicateKeys"
    spark.conf.set(name, "true")
    try:
        with pytest.raises(SnapshotError, match="bad_session"):
            _accepted(spark, ["{}"])
    finally:
        spark.conf.unset(name)


def test_bytes_must_be_utf8(spark):
    bodies = [b'{"a": "\xc3\xa9"}', b'{"a": "\xff"}', b"\xff"]
    assert _accepted(spark, bodies, "binary") == [True, False, False]


@pytest.mark.parametrize(
    "token,value",
    [("0", 0), ("9223372036854775807", 2**63 - 1), ("-0", 0), ("-1", -1), ("true", None),
     ("false", None), ("1.5", None), ("1.0", None), ("1e3", None), ('"3"', None), ("null", None),
     ("9223372036854775808", None), ("1" * 60, None), ("[]", None), ("{}", None)],
)
def test_integer_tokens(spark, token, value):
    frame = spark.createDataFrame([(token,)], "body string")
    parsed = J.with_strict_json(frame, "body", "doc").select(J.integer_of("doc").alias("n"))
    assert parsed.first().n == value


def test_strings_are_not_coerced(spark):
    frame = spark.createDataFrame([('"7"',), ("7",), ("true",), ("null",), ("{}",)], "body string")
    parsed = J.with_strict_json(frame, "body", "doc").select(J.string_of("doc").alias("s"))
    assert [r.s for r in parsed.collect()] == ["7", None, None, None, None]
