"""JSON that is refused rather than guessed at: VARIANT with type gates."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, functions as F

from staytally.errors import SnapshotError
from staytally.functions.scalars import _col, strict_date

_LENIENT = "spark.sql.variant.allowDuplicateKeys"


def with_strict_json(frame: DataFrame, body: Column | str, name: str) -> DataFrame:
    """Add a VARIANT column: the one JSON document in ``body``, else NULL.

    VARIANT already refuses repeated keys and NaN, but it ignores text after the
    document. Parsing the body as the first of two array elements exposes that:
    anything but one document moves or hides the closing mark, which is random
    so that no body can supply it.

    Each step is a column of its own, so the optimizer keeps them apart and a
    body is parsed once however often the result is used.
    """
    if frame.sparkSession.conf.get(_LENIENT, "false") == "true":
        raise SnapshotError("bad_session", f"{_LENIENT} would accept repeated keys")
    mark = uuid4().hex
    text = F.try_validate_utf8(_col(body).cast("string"))
    wrapped = F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{mark}"]')))
    pair = frame.withColumn("_wrapped", wrapped).withColumn(
        "_pair", F.try_variant_get("_wrapped", "$", "array<variant>")
    )
    last = F.try_variant_get(F.get("_pair", F.lit(1)), "$", "string")
    closed = (F.size("_pair") == 2) & (last == mark)
    document = F.when(closed, F.get("_pair", F.lit(0)))
    return pair.withColumn(name, document).drop("_wrapped", "_pair")


def variant_type(value: Column | str) -> Column:
    return F.schema_of_variant(_col(value))


def is_absent(value: Column | str) -> Column:
    """The key is missing, as opposed to present with a JSON null."""
    return _col(value).isNull()


def string_of(value: Column | str) -> Column:
    """Text of a JSON string; NULL for every other type, which a bare cast would coerce."""
    value = _col(value)
    return F.when(variant_type(value) == "STRING", F.try_variant_get(value, "$", "string"))


def integer_of(value: Column | str) -> Column:
    """BIGINT of an integer token; NULL for booleans, fractions, strings and overflow."""
    value = _col(value)
    return F.when(variant_type(value) == "BIGINT", F.try_variant_get(value, "$", "bigint"))


def date_of(value: Column | str) -> Column:
    return strict_date(string_of(value))
