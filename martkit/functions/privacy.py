"""Pseudonyms for personal identifiers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.functions.portable import Name, as_col

# Output width of the pseudonym, size of the synthetic pool, multiplier that scatters it.
PSEUDONYM_DIGITS = 16
SUBJECT_POOL = 5000
SUBJECT_MULTIPLIER = 2654435761


def secret(value: str) -> Column:
    """A text as a column whose plan does not show it: the one value of a one-row table, fetched when a query runs.

    A literal would stand in every plan, and so in the UI and in event logs.
    """
    return SparkSession.active().createDataFrame([(value,)], "secret string").scalar()


def pseudonymize(c: Name, salt: str | Column) -> Column:
    """First 16 hexadecimal digits of the SHA-256 of salt followed by value; null stays null.

    The salt is a text, which plans won't show, or a column, such as ``secret`` or the scalar of a key table gives.
    """
    hidden = secret(salt) if isinstance(salt, str) else salt
    return F.substring(F.sha2(F.concat(hidden, as_col(c).cast("string")), 256), 1, PSEUDONYM_DIGITS)


def synthetic_subject(key: Name, domain: str, pool: int = SUBJECT_POOL) -> Column:
    """Clear-text identifier ``driver<number>@<domain>`` of an invented person, fixed by an integer key.

    Key and multiplier are reduced before they meet, so no 64-bit key can overflow.
    """
    size = F.lit(pool).cast("bigint")
    number = F.pmod(F.pmod(as_col(key).cast("bigint"), size) * F.lit(SUBJECT_MULTIPLIER % pool), size)
    return F.concat(F.lit("driver"), number.cast("string"), F.lit(f"@{domain}"))


def protect(df: DataFrame, columns: Mapping[str, str], salt: str | Column) -> DataFrame:
    """Replace each clear column by its pseudonym: ``{clear name: pseudonym name}``."""
    hidden = secret(salt) if isinstance(salt, str) else salt
    pseudonyms = {new: pseudonymize(old, hidden) for old, new in columns.items()}
    return df.withColumns(pseudonyms).drop(*columns)
