"""Text forms that values take in the landing area.

Landing files carry text only, so the form each type is written in is the form that bronze and silver hold.
All of it is built-in expressions, evaluated in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.names import column

# From 1e16 on, and below 1e-4, a float is written with an exponent; between them it is not.
EXPONENT_FROM = 1e16
EXPONENT_BELOW = 1e-4
# Between these, Spark's own text of a double has no exponent.
SHORT_FROM = 1e-3
SHORT_BELOW = 1e7


def float_text(value: Column) -> Column:
    """``10000000.0``, ``0.00015``, ``1e+16``, ``1.5e-05``; NaN has no text and becomes null."""
    size = F.abs(value)
    # Most values are short. The rest is a lambda to keep it out of the generated code: spelled out once per float
    # column it makes a method too long for Java to compile, which costs all rows several times the work.
    long_text = F.transform(F.array(value.cast("string")), lambda text: _long_float_text(text, size))[0]
    return F.when(((size >= SHORT_FROM) & (size < SHORT_BELOW)) | (size == 0), value.cast("string")).when(
        ~F.isnan(value), long_text
    )


def _long_float_text(text: Column, size: Column) -> Column:
    # Decimal(38, 22) holds every digit of a double between the two bounds.
    plain = F.regexp_replace(text.try_cast("decimal(38,22)").cast("string"), r"(\.\d+?)0+$", "$1")
    # 1.0E16 to 1E16, Infinity to Inf; then 1E+16; then 1.5E-05.
    bare = F.regexp_replace(text, r"\.0(?=E)|inity$", "")
    signed = F.regexp_replace(bare, r"E(?=\d)", "E+")
    with_exponent = F.lower(F.regexp_replace(signed, r"E-(?=\d$)", "E-0"))
    return F.when((size >= EXPONENT_BELOW) & (size < EXPONENT_FROM), plain).otherwise(with_exponent)


def text_form(value: Column, data_type: T.DataType) -> Column:
    """The landing text of one value of ``data_type``."""
    if isinstance(data_type, T.StringType):
        return value
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return float_text(value)
    if isinstance(data_type, T.BooleanType):
        return F.when(value, F.lit("True")).when(~value, F.lit("False"))
    if isinstance(data_type, T.BinaryType):
        return F.base64(value)
    if isinstance(data_type, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return F.to_json(value)
    return value.cast("string")


def as_text(df: DataFrame) -> DataFrame:
    """Every column in its landing text form, in one projection."""
    return df.select(*(text_form(column(f.name), f.dataType).alias(f.name) for f in df.schema.fields))
