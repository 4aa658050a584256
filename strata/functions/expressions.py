"""Scalar column builders shared by the cleaning and analysis operators.

All of them are built from ``pyspark.sql.functions`` so they stay inside
whole-stage codegen. Text is typed with ``try_cast``/``try_to_date`` so a bad
cell becomes NULL instead of failing the job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "GRAV_UNHARMED", "GRAV_KILLED", "GRAV_HOSPITALISED", "GRAV_LIGHT",
    "SEVERITY_SCORE", "SERIOUS_MIN_SCORE", "HHMM_PATTERN",
    "col_of", "hour_from_hrmn", "severity_score", "flag", "safe_ratio",
    "safe_int", "decimal_comma", "date_from_parts",
    "weekday_from_parts", "hour_bucket", "nonblank", "count_where",
]

# ---- fixed values (must equal the source data's code lists) -----------------
# Person severity codes `grav`: 1 unharmed, 2 killed, 3 hospitalised,
# 4 lightly injured. The codes are not ordered by severity, so they are mapped
# to an increasing score before taking a maximum: 2->4, 3->3, 4->2, 1->1,
# anything else -> NULL. An accident is serious when its max score is >= 3.
GRAV_UNHARMED, GRAV_KILLED, GRAV_HOSPITALISED, GRAV_LIGHT = 1, 2, 3, 4
SEVERITY_SCORE = {2: 4, 3: 3, 4: 2, 1: 1}
SERIOUS_MIN_SCORE = 3
# Hour text is accepted only as two digits, a colon, two digits.
HHMM_PATTERN = r"^[0-9]{2}:[0-9]{2}$"
# ---------------------------------------------------------------------------


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_from_hrmn(hrmn: str | Column) -> Column:
    """Integer hour from ``HH:MM`` text; NULL when the text has another shape.

    Only the shape is checked (``24:10`` gives 24), as in the source rule; the
    quality report flags hours above 23 separately.
    """
    c = col_of(hrmn)
    return F.when(c.rlike(HHMM_PATTERN), F.substring(c, 1, 2).try_cast("int"))


def severity_score(grav: str | Column) -> Column:
    """Map a ``grav`` code to the increasing score (NULL for unknown codes)."""
    c = col_of(grav)
    out = None
    for code, score in SEVERITY_SCORE.items():
        out = F.when(c == code, F.lit(score)) if out is None else out.when(c == code, F.lit(score))
    return out


def flag(predicate: Column) -> Column:
    """Boolean -> 0/1 int, NULL stays NULL."""
    return predicate.cast("int")


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den as double; NULL when den is 0 or NULL (never raises)."""
    return F.try_divide(col_of(num).cast("double"), col_of(den).cast("double"))


def safe_int(c: str | Column) -> Column:
    return col_of(c).try_cast("int")


def decimal_comma(c: str | Column) -> Column:
    """French decimal text ``48,85`` -> 48.85 (NULL when not a number)."""
    return F.regexp_replace(col_of(c).cast("string"), ",", ".").try_cast("double")


def date_from_parts(an: str | Column, mois: str | Column, jour: str | Column) -> Column:
    """DATE from year/month/day parts; NULL for impossible dates (31 February)."""
    text = F.concat_ws(
        "-",
        F.lpad(col_of(an).cast("string"), 4, "0"),
        F.lpad(col_of(mois).cast("string"), 2, "0"),
        F.lpad(col_of(jour).cast("string"), 2, "0"),
    )
    return F.try_to_date(text, "yyyy-MM-dd")


def weekday_from_parts(an, mois, jour) -> Column:
    """Day of week, 1 = Sunday ... 7 = Saturday (Spark's numbering)."""
    return F.dayofweek(date_from_parts(an, mois, jour))


def hour_bucket(hour: str | Column) -> Column:
    """Four six-hour buckets of the day; NULL hour stays NULL."""
    h = col_of(hour)
    return (F.when(h < 6, "night").when(h < 12, "morning")
            .when(h < 18, "afternoon").when(h <= 23, "evening"))


def nonblank(c: str | Column) -> Column:
    """True when the value has at least one non-space character."""
    return F.length(F.trim(col_of(c).cast("string"))) > 0


def count_where(cond: Column) -> Column:
    """Aggregate: rows where ``cond`` is true, as bigint (0 when none)."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")
