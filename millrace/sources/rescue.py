"""Conform rows to a declared schema and keep what does not fit as text."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.schema import RESCUED


def _scalar(value: Column, source: T.DataType, target: T.DataType) -> tuple[Column, Column]:
    cast = value.try_cast(target)
    if isinstance(source, T.StringType):
        # A text fits if it says just that value: no time of day behind a date, no digits beyond a decimal's scale.
        if isinstance(target, T.DateType):
            kept = value.try_cast(T.TimestampNTZType()) == cast.cast(T.TimestampNTZType())
        elif isinstance(target, T.DecimalType):
            kept = value.try_cast(T.DecimalType(38, max(target.scale, 18))) == cast
        else:
            kept = cast.isNotNull()
    elif isinstance(target, T.StringType):
        kept = cast.isNotNull()
    else:
        # Casting back must give the source: no fraction, time of day or digit is lost.
        kept = cast.try_cast(source).eqNullSafe(value)
    return F.when(kept, cast), value.isNull() | F.coalesce(kept & cast.isNotNull(), F.lit(False))


def _fitted(value: Column, source: T.DataType, target: T.DataType) -> tuple[Column, Column]:
    """What of a value fits the target, and whether all of it does.

    Structs are compared field by field, arrays element by element; a field the target lacks does not fit unless it is NULL.
    """
    if source == target:
        return value, F.lit(True)
    if isinstance(source, T.StructType) and isinstance(target, T.StructType):
        present = {f.name.lower(): f for f in source.fields}
        declared = {f.name.lower() for f in target.fields}
        parts, fits = [], [value[f.name].isNull() for k, f in present.items() if k not in declared]
        for field in target.fields:
            own = present.get(field.name.lower())
            if own is None:
                parts.append(F.lit(None).cast(field.dataType).alias(field.name))
                continue
            part, fit = _fitted(value[own.name], own.dataType, field.dataType)
            parts.append(part.alias(field.name))
            fits.append(fit)
        return F.when(value.isNotNull(), F.struct(*parts)), value.isNull() | reduce(and_, fits, F.lit(True))
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        kinds = (source.elementType, target.elementType)
        fits = F.forall(value, lambda x: _fitted(x, *kinds)[1])
        return F.transform(value, lambda x: _fitted(x, *kinds)[0]), value.isNull() | F.coalesce(fits, F.lit(False))
    return _scalar(value, source, target)


def conform(df: DataFrame, schema: T.StructType, rescued: str = RESCUED) -> DataFrame:
    """Cast every declared column; put misfits and undeclared columns into ``rescued``.

    A value fits only if nothing of it is lost: 10.7 is no whole number, a time of day no date, and a number with more
    digits than the declared type holds does not fit. What does not fit is NULL in its column (inside a struct or array,
    in its field or element). ``rescued`` is a JSON object of the source values, NULL when the row fitted. A
    declared column the source lacks becomes NULL. Works on batch and stream alike:
    it is one projection.
    """
    present = {c.lower(): c for c in df.columns}
    declared = {f.name.lower() for f in schema.fields}
    columns, leftovers = [], []
    for f in schema.fields:
        source = present.get(f.name.lower())
        if source is None:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        value = F.col(source)
        if df.schema[source].dataType == f.dataType:
            columns.append(value.alias(f.name))
            continue
        fitting, fits = _fitted(value, df.schema[source].dataType, f.dataType)
        columns.append(fitting.cast(f.dataType).alias(f.name))
        leftovers.append(F.when(~fits, value).alias(f.name))
    leftovers += [F.col(c) for c in df.columns if c.lower() not in declared and c != rescued]
    text = F.lit(None).cast("string")
    if leftovers:
        # Most rows fit; only the others are turned into JSON.
        misfit = reduce(or_, [c.isNotNull() for c in leftovers])
        text = F.when(misfit, F.to_json(F.struct(*leftovers)))
    if rescued in df.columns:
        text = F.coalesce(F.col(rescued), text)
    return df.select(*columns, text.alias(rescued))
