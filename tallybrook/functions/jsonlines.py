"""JSON text to typed columns and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallybrook.schemas import LOG


def _relaxed(t: T.DataType) -> T.DataType:
    """The type with every leaf a string, which no JSON value fails to fit."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _relaxed(f.dataType)) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_relaxed(t.elementType))
    if isinstance(t, T.MapType):
        return T.MapType(T.StringType(), _relaxed(t.valueType))
    return T.StringType()


def _typed(c: Column, t: T.DataType) -> Column:
    """A relaxed value in its declared type; what does not fit is NULL."""
    if t == _relaxed(t):
        return c
    if isinstance(t, T.StructType):
        fields = [_typed(c[f.name], f.dataType).alias(f.name) for f in t.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(t, T.ArrayType):
        return F.transform(c, lambda e: _typed(e, t.elementType))
    if isinstance(t, T.MapType):
        return F.transform_values(c, lambda _, v: _typed(v, t.valueType))
    return c.try_cast(t)


def read_json(df: DataFrame, schema: T.StructType, value: str = "value",
              keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse each line once into the struct ``j``, next to the ``keep`` columns.

    Fields are cast one by one: ``"5"`` reads as the number 5, a field of the
    wrong kind as NULL; text that is no JSON object gives a struct of NULLs.
    The generator is a fence: without it a filter on a parsed field would be
    pushed below the projection and parse every line a second time.
    """
    text = F.trim(F.col(value))
    whole = F.when(
        F.startswith(text, F.lit("{")) & F.endswith(text, F.lit("}"))
        & one_value(F.col(value)),
        F.col(value),
    )
    parsed = F.from_json(whole, _relaxed(schema))
    once = df.select(*keep, F.explode(F.array(parsed)).alias("_j"))
    return once.select(*keep, _typed(F.col("_j"), schema).alias("j"))


def one_value(text: Column) -> Column:
    """Whether a text is one JSON value with nothing behind it.  Parsers stop after
    the first value, so the text is read as an array of one element."""
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    nth = lambda n: F.try_variant_get(listed, f"$[{n}]", "variant")
    return nth(0).isNotNull() & nth(1).isNull()


def strict(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Parse; a malformed line fails the job."""
    parsed = F.from_json(F.col(value), schema, {"mode": "FAILFAST"})
    return df.select(parsed.alias("j")).select("j.*")


def records(df: DataFrame, schema: T.StructType, value: str = "value",
            keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON lines to typed records: absent fields are NULL, unknown ones ignored.

    ``keep`` names further input columns (record time, offset) to carry along.
    """
    return read_json(df, schema, value, keep).select("j.*", *keep)


def parse_log(lines: DataFrame, value: str = "value", schema: T.StructType = LOG,
              keep: tuple[str, ...] = ()) -> DataFrame:
    """Log lines to typed log rows plus ``raw`` and the flag ``dirty``.

    Dirty is whatever cannot be keyed or timed: no JSON object or more than one,
    an empty line, no ``common.mid``, or no whole number in ``ts``.
    """
    named = lines.select(F.col(value).alias("raw"), *keep)
    return read_json(named, schema, "raw", ("raw", *keep)).select(
        "raw", "j.*", *keep, (F.col("j.common.mid").isNull() | F.col("j.ts").isNull()).alias("dirty")
    )


def good_lines(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~F.col("dirty")).drop("dirty")


def dirty_lines(parsed: DataFrame) -> DataFrame:
    return parsed.filter("dirty").select("raw")


def as_value(df: DataFrame, *columns: str) -> DataFrame:
    """Rows to one JSON string column ``value``; NULL fields are left out."""
    return df.select(F.to_json(F.struct(*(columns or df.columns))).alias("value"))
