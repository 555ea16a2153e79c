"""Null-aware column expressions used across the plans."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def identified(key) -> Column:
    """A usable identifier: neither NULL nor only spaces (trim drops spaces alone)."""
    return F.trim(_column(key)) != ""


def blank_key(key) -> Column:
    return F.coalesce(F.trim(_column(key)) == "", F.lit(True))


def not_finite(value) -> Column:
    """NaN or infinite; NULL for an unknown number. Spark has no isfinite of its own."""
    number = _column(value).cast("double")
    return F.isnan(number) | (F.abs(number) == float("inf"))


def finite(value) -> Column:
    return _column(value).isNotNull() & ~not_finite(value)


def known_status(status) -> Column:
    """Open-access status with blanks and NULL grouped as 'unknown'."""
    return F.coalesce(F.nullif(F.trim(_column(status)), F.lit("")), F.lit("unknown"))


def percentage(part, whole) -> Column:
    """100 * part / whole as DOUBLE; NULL for an empty whole."""
    return F.lit(100.0) * _column(part) / F.nullif(_column(whole), F.lit(0))


def doi_link(doi) -> Column:
    """The DOI when it is a link to the DOI resolver, else NULL."""
    value = _column(doi)
    return F.when(value.startswith("https://doi.org/") | value.startswith("http://doi.org/"), value)


def label(name, identifier) -> Column:
    return F.coalesce(_column(name), _column(identifier))


def citations_per_year(citations, year, reference_year: int) -> Column:
    """Citations per inclusive calendar year of age; NULL for unknown or future years."""
    year = _column(year)
    age = F.greatest(F.lit(1), F.lit(reference_year) - year + 1)
    return F.when(year <= reference_year, _column(citations) * F.lit(1.0) / age)
