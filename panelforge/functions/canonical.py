"""Canonical JSON of nested columns: keys sorted, no blanks, characters beyond ASCII as they are, numbers in their shortest form.

The text is that of ``json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)``, so its digest is the
same wherever it is computed. It is built from built-in expressions by the column's type. Nulls are ``null``, days ISO texts,
timestamps ISO texts of the session's zone with ``+00:00`` (the session is in UTC). Doubles have the digits of
Java's ``Double.toString``, the shortest ones but for rare values on Java before 19.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Control characters without a short form, as JSON has them.
_CONTROL = {chr(c): f"\\u{c:04x}" for c in range(32) if chr(c) not in "\b\t\n\f\r"}


def _once(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is named."""
    return F.element_at(F.transform(F.array(value), use), 1)


def text_json(text: Column) -> Column:
    quoted = F.lit('"')
    for raw, shown in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f")):
        text = F.replace(text, F.lit(raw), F.lit(shown))

    def rare(t: Column) -> Column:
        out = t
        for raw, shown in _CONTROL.items():
            out = F.replace(out, F.lit(raw), F.lit(shown))
        return F.concat(quoted, F.when(t.rlike("[\\x00-\\x1f]"), out).otherwise(t), quoted)

    return _once(text, rare)


def _digits(shown: Column) -> Column:
    """Java's text of a positive number as JSON."""
    parts = F.struct(F.regexp_replace(F.element_at(F.split(shown, "E"), 1), r"\.0$", "").alias("mantissa"), F.get(F.split(shown, "E"), 1).cast("int").alias("power"))

    def placed(p: Column) -> Column:
        mantissa, power, digits = p["mantissa"], p["power"], F.replace(p["mantissa"], F.lit("."), F.lit(""))
        whole = F.when(F.length(digits) <= power + 1, F.concat(F.rpad(digits, power + 1, "0"), F.lit(".0"))).otherwise(F.concat(F.substring(digits, F.lit(1), power + 1), F.lit("."), F.substring(digits, power + 2, F.lit(400))))
        small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
        far = F.concat(mantissa, F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")), F.when(F.abs(power) < 10, F.lit("0")).otherwise(F.lit("")), F.abs(power).cast("string"))
        return F.when((power >= 7) & (power < 16), whole).when((power < 0) & (power >= -4), small).otherwise(far)

    return F.when(~shown.contains("E"), shown).otherwise(_once(parts, placed))


def double_json(x: Column) -> Column:
    """Plain digits from 0.0001 to below 10^16, else an exponent of two digits or more."""

    def signed(v: Column) -> Column:
        minus = F.when(v.cast("string").startswith("-"), F.lit("-")).otherwise(F.lit(""))
        return F.when(F.isnan(v), "NaN").when(F.abs(v) == float("inf"), F.concat(minus, F.lit("Infinity"))).otherwise(F.concat(minus, _once(F.abs(v).cast("string"), _digits)))

    return _once(x, signed)


def value_json(value: Column, kind: T.DataType) -> Column:
    """JSON text of a column of this type; null values are ``null``."""
    if isinstance(kind, T.StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        parts = [F.concat(F.lit(("," if i else "") + '"' + f.name.replace("\\", "\\\\").replace('"', '\\"') + '":'), value_json(value.getField(f.name), f.dataType)) for i, f in enumerate(fields)]
        shown = F.concat(F.lit("{"), *parts, F.lit("}"))
    elif isinstance(kind, T.ArrayType):
        shown = F.concat(F.lit("["), F.array_join(F.transform(value, lambda v: value_json(v, kind.elementType)), ","), F.lit("]"))
    elif isinstance(kind, T.MapType):
        entry = lambda e: F.concat(text_json(e["key"].cast("string")), F.lit(":"), value_json(e["value"], kind.valueType))
        keys = F.array_sort(F.map_keys(value))
        shown = F.concat(F.lit("{"), F.array_join(F.transform(keys, lambda k: entry(F.struct(k.alias("key"), F.element_at(value, k).alias("value")))), ","), F.lit("}"))
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        shown = double_json(value.cast("double"))
    elif isinstance(kind, T.BooleanType) or isinstance(kind, (T.IntegralType, T.DecimalType)):
        shown = value.cast("string")
    elif isinstance(kind, T.TimestampType):
        shown = F.concat(F.lit('"'), F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.date_format(value, "SSSSSS") != "000000", F.concat(F.lit("."), F.date_format(value, "SSSSSS"))).otherwise(F.lit("")), F.lit('+00:00"'))
    elif isinstance(kind, T.DateType):
        shown = F.concat(F.lit('"'), value.cast("string"), F.lit('"'))
    else:
        shown = text_json(value.cast("string"))
    return F.coalesce(F.when(value.isNotNull(), shown), F.lit("null"))


def canonical_json(df: DataFrame, column: str) -> Column:
    return value_json(F.col(column), df.schema[column].dataType)
