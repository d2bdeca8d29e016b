"""Text cleaning and key normalisation (Column -> Column, all JVM-side)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col_of


def clean_text(c: Column | str) -> Column:
    """Cast to string, trim blanks, turn '' into NULL."""
    return F.nullif(F.trim(col_of(c).cast("string")), F.lit(""))


def normalize_key(c: Column | str) -> Column:
    """Join key form of a free-text name: upper case of :func:`clean_text` (blank -> NULL)."""
    return F.upper(clean_text(c))


def alias_map(c: Column | str, mapping: Iterable[tuple[str, str]]) -> Column:
    """Canonical name for a short name; unknown values pass through as their key form.

    ``mapping`` pairs are (short name in key form, canonical name). The result of every branch is in
    key form, so equal names from different sources compare equal.
    """
    key = normalize_key(c)
    out = key
    for short, canonical in reversed(list(mapping)):
        out = F.when(key == F.lit(short.upper()), F.lit(canonical)).otherwise(out)
    return out


def exclude_values_predicate(c: Column | str, values: Iterable[str]) -> Column:
    """Predicate of B18: ``c NOT IN (values)``; NULL ``c`` is dropped too (three-valued logic)."""
    return ~col_of(c).isin(list(values))
