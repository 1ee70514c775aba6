"""Column helpers with the null, zero and NaN guards that ANSI mode makes necessary."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T


def column(name: str) -> Column:
    """Column by its literal name, whatever characters it holds."""
    return F.col(quoted(name))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def double_array(values: Iterable[float]) -> str:
    """SQL text of a constant array; a column per element would make planning slow."""
    return f"cast(split('{','.join(repr(float(v)) for v in values)}', ',') as array<double>)"


def ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def safe_ln(x: Column) -> Column:
    return F.when(x > 0, F.ln(x))


def divergence(left: Column, right: Column) -> Column:
    """``(left - right) * ln(left / right)``; 0 where either share is empty or missing."""
    return F.when((left > 0) & (right > 0), (left - right) * F.ln(left / right)).otherwise(F.lit(0.0))


def is_missing(df: DataFrame, name: str) -> Column:
    """True for NULL, and for NaN in floating columns."""
    c = column(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def nan_to_null(df: DataFrame) -> DataFrame:
    """One notion of "missing": NaN becomes NULL in every floating column."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({n: F.when(~F.isnan(column(n)), column(n)) for n in floating}) if floating else df


def as_number(df: DataFrame, name: str) -> Column:
    """Numeric or boolean column as double: NaN is NULL and -0.0 is 0.0."""
    kind = df.schema[name].dataType
    c = column(name)
    if isinstance(kind, T.BooleanType):
        return c.cast("int").cast("double")
    c = c.cast("double")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        c = F.when(~F.isnan(c), c)
    return c + F.lit(0.0)


def insert_column(df: DataFrame, position: int, name: str, value: Column) -> DataFrame:
    names = [column(n) for n in df.columns]
    return df.select(*names[:position], value.alias(name), *names[position:])


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[column(n).alias(f"{prefix}{n}") for n in df.columns])


def rename_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Positional renaming of all columns."""
    return df.toDF(*names)


def model_stamp(model_type: str, moment: Column) -> Column:
    """Model name ``{type}_{yymmdd_HHMMSS}``."""
    return F.concat(F.lit(f"{model_type}_"), F.date_format(moment, "yyMMdd_HHmmss"))
