"""Text normalisation and similarity from built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(c: Column | str) -> Column:
    """Distinct lower-case words of a text; empty when the text is null."""
    words = F.split(F.lower(F.coalesce(_col(c), F.lit(""))), "[^\\p{L}\\p{N}]+")
    return F.array_sort(F.array_distinct(F.filter(words, lambda w: w != "")))


def token_sorted(c: Column | str) -> Column:
    """Lower-case text with its words in alphabetical order, so word order does not matter."""
    words = F.split(F.lower(F.trim(_col(c))), "\\s+")
    return F.array_join(F.array_sort(words), " ")


def edit_similarity(a: Column | str, b: Column | str) -> Column:
    """1 - edit distance / longer length: 1 for equal texts, 0 for nothing in common."""
    a, b = _col(a), _col(b)
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer == 0, F.lit(0.0)).otherwise(F.lit(1.0) - F.levenshtein(a, b) / longer)


def jaccard(a: Column | str, b: Column | str) -> Column:
    a, b = _col(a), _col(b)
    return F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b)))


EMAIL_PATTERN = "^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$"


def email_norm(c: Column | str) -> Column:
    """Trimmed lower-case address, null when malformed."""
    mail = F.lower(F.trim(_col(c)))
    return F.when(mail.rlike(EMAIL_PATTERN), mail)


def phone_e164(c: Column | str, country: str = "91", national_digits: int = 10) -> Column:
    """International form; a bare national number gets the default country, else null."""
    digits = F.regexp_replace(_col(c), "\\D", "")
    full = national_digits + len(country)
    return (
        F.when(F.length(digits) == national_digits, F.concat(F.lit("+" + country), digits))
        .when((F.length(digits) == full) & digits.startswith(country), F.concat(F.lit("+"), digits))
    )
