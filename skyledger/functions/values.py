"""JSON text, points, fixed-width codes and surrogate keys as column expressions."""

import functools
import operator

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])


def json_field(col: Column, key: str) -> Column:
    """The value of a top-level key as text; NULL when the input or the key is missing.

    Strings come back exactly; a number comes back in its shortest form (1.50 as 1.5).
    """
    return F.get_json_object(col, f"$['{key}']")


def canonical_json(col: Column) -> Column:
    """JSON text with sorted keys and no spacing, so that equal documents are equal text.

    Malformed JSON fails the job, as it would fail a jsonb column.
    """
    return F.to_json(F.parse_json(col))


def json_document(col: Column, data_type: T.DataType, empty_is_null: bool = False) -> Column:
    """Serialise a nested value, or normalise JSON text; NULL stays NULL."""
    text = F.to_json(col) if not isinstance(data_type, T.StringType) else col
    text = canonical_json(text)
    if empty_is_null:
        text = F.when(~text.isin("{}", "[]", '""', "0", "false", "null"), text)
    return text


def point_from_text(col: Column) -> Column:
    """'(x,y)' to struct<x,y>."""
    x = F.regexp_extract(col, r"^\(\s*([^,\s]+)\s*,\s*([^)\s]+)\s*\)$", 1)
    y = F.regexp_extract(col, r"^\(\s*([^,\s]+)\s*,\s*([^)\s]+)\s*\)$", 2)
    return F.when(col.isNotNull(), F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")))


def point_to_text(col: Column) -> Column:
    return F.when(
        col.isNotNull(),
        F.concat(F.lit("("), col["x"].cast("string"), F.lit(","), col["y"].cast("string"), F.lit(")")),
    )


def key_part(col: Column) -> Column:
    """A key column as text in which `|` only stands behind a backslash, so that joined texts are unambiguous."""
    escaped = F.replace(col.cast("string"), F.lit("\\"), F.lit("\\\\"))
    return F.replace(escaped, F.lit("|"), F.lit("\\|"))


def key_text(*cols: Column) -> Column:
    return F.concat_ws("|", *[key_part(c) for c in cols])


def stable_id(table: str, *keys: Column) -> Column:
    """A UUID-shaped id that depends only on the table and the natural key.

    A random id would change whenever a lost task is run again.
    """
    digest = F.md5(key_text(F.lit(table), *keys))
    parts = [F.substring(digest, at, size) for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat_ws("-", *parts)


def any_differs(pairs) -> Column:
    """True when any pair of columns is distinct, NULL being a value like any other."""
    return functools.reduce(operator.or_, [~a.eqNullSafe(b) for a, b in pairs], F.lit(False))
