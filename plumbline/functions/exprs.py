"""Small column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def holds(cond: Column) -> Column:
    """A predicate that is false, not null, when it cannot be decided."""
    return F.coalesce(cond, F.lit(False))


def has_code(codes: Column | str, code: str) -> Column:
    """Exact membership in a comma list (a substring test would confuse similar codes)."""
    if isinstance(codes, str):
        return F.expr(f"coalesce(array_contains(split({codes}, ','), '{code}'), false)")
    return holds(F.array_contains(F.split(codes, ","), code))


def ratio(num: Column, den: Column) -> Column:
    """Null when the denominator is zero."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def bucket(value: Column, steps: list[tuple[float, str]], otherwise: str) -> Column:
    """First label whose lower bound the value reaches; bounds given high to low."""
    out = None
    for bound, label in steps:
        test = value >= F.lit(bound)
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.otherwise(otherwise) if out is not None else F.lit(otherwise)


def first_column(df: DataFrame, names: list[str], dtype: str) -> Column:
    """The first of several spellings the table has, else a typed null."""
    for n in names:
        if n in df.columns:
            return F.col(n)
    return F.lit(None).cast(dtype)


def with_one_row(df: DataFrame, one: DataFrame) -> DataFrame:
    """Add the columns of a one-row result to every row, as a scalar subquery rather than a join."""
    row = one.select(F.struct("*").alias("__one")).scalar()
    return df.withColumn("__one", row).select(*df.columns, "__one.*")


def decimals_as_double(df: DataFrame) -> DataFrame:
    """Reporting form: exact decimals leave the engine as doubles."""
    money = {
        f.name: F.col(f"`{f.name}`").cast("double")
        for f in df.schema.fields
        if isinstance(f.dataType, T.DecimalType)
    }
    return df.withColumns(money) if money else df


def lookup(mapping: dict[str, str], key: Column) -> Column:
    """A short fixed mapping as one expression; null for an unknown key."""
    out = None
    for k, v in mapping.items():
        out = F.when(key == k, F.lit(v)) if out is None else out.when(key == k, F.lit(v))
    return out
