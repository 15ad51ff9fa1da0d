"""Surrogate keys: SHA-256 over the readable form of the natural key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# fixed values: null marker, separator and the text hashed for the anonymous bucket
PACKED = "struct<head:string,tail:binary>"
NULL_MARK, SEPARATOR, ANON_TEXT = "~NULL~", "|", "__ANON_BUCKET__"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def readable_key(*parts: Column | str) -> Column:
    """The natural key as one text; a null part becomes a marker, so the key is never null."""
    if not parts:
        raise ValueError("a key needs at least one column")
    if all(isinstance(p, str) for p in parts):  # columns by name: one expression text
        return F.expr(_readable(parts))
    return F.concat_ws(
        SEPARATOR, *[F.coalesce(_col(p).cast("string"), F.lit(NULL_MARK)) for p in parts]
    )


def _readable(parts) -> str:
    texts = ", ".join(f"coalesce(cast({p} AS string), '{NULL_MARK}')" for p in parts)
    return f"concat_ws('{SEPARATOR}', {texts})"


def surrogate_key(*parts: Column | str) -> Column:
    if parts and all(isinstance(p, str) for p in parts):
        return F.expr(f"sha2({_readable(parts)}, 256)")
    return F.sha2(readable_key(*parts), 256)


def optional_key(part: Column | str) -> Column:
    """Foreign key of an optional reference: null stays null instead of hashing the marker."""
    if isinstance(part, str):
        return F.expr(f"sha2(cast({part} AS string), 256)")
    return F.sha2(part.cast("string"), 256)


def date_key(day: Column | str) -> Column:
    """Foreign key into the calendar; null while the milestone has not happened."""
    if isinstance(day, str):
        return F.expr(f"sha2(date_format({day}, 'yyyy-MM-dd'), 256)")
    return F.sha2(F.date_format(day, "yyyy-MM-dd"), 256)


def anonymous_key() -> Column:
    """The one key shared by every row nobody can be identified for."""
    return F.sha2(F.lit(ANON_TEXT), 256)


def pack(df: DataFrame, *columns: str) -> DataFrame:
    """The columns that are texts as (head, tail): 64 hexadecimal digits at their end take half of their bytes while
    they move. Equal where the texts are equal; null for null. Columns of other types stay."""
    texts = [c for c, kind in df.dtypes if c in columns and kind == "string"]
    df = df.withColumns({f"__digits_{c}": F.substring(c, -64, 64) for c in texts})
    digits = {c: F.col(f"__digits_{c}") for c in texts}
    df = df.withColumns({
        f"__tail_{c}": F.when((F.octet_length(d) == 64) & (F.lower(F.hex(F.unhex(d))) == d), F.unhex(d)) for c, d in digits.items()})
    head = {c: F.expr(f"substring(`{c}`, 1, length(`{c}`) - if(`__tail_{c}` is null, 0, 64))") for c in texts}
    return df.withColumns({
        c: F.when(F.col(c).isNotNull(), F.struct(head[c].alias("head"), F.col(f"__tail_{c}").alias("tail"))) for c in texts
    }).drop(*[f"__{of}_{c}" for c in texts for of in ("digits", "tail")])


def unpack(df: DataFrame, *columns: str) -> DataFrame:
    """The texts that `pack` took apart, unchanged."""
    return df.withColumns({
        c: F.concat(F.col(c)["head"], F.coalesce(F.lower(F.hex(F.col(c)["tail"])), F.lit("")))
        for c, kind in df.dtypes if c in columns and kind == PACKED})
