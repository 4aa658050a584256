"""Bronze -> silver cleaning: duplicates, required keys, ranges, trims, reasons.

A table's cleaning is declared as :class:`CleanRules`; every rule is a plain
column predicate so Catalyst can push the null tests into the Parquet scan.
The order is the source's: full-row duplicates first, then row filters, then
normalisations (trims), then, where the key must be unique, one row per key.

Duplicates are judged on whole source rows: every column of the source takes part,
also those that no analysis reads, so rows that differ anywhere stay apart.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from strata.functions.expressions import col_of, count_where, date_from_parts, nonblank


@dataclass(frozen=True)
class CleanRules:
    key: str = "num_acc"
    required: tuple[str, ...] = ()
    ranges: dict[str, tuple[int, int]] = field(default_factory=dict)
    trim: tuple[str, ...] = ()
    nonnegative: tuple[str, ...] = ()          # a value below zero is an outlier
    dates: tuple[tuple[str, str, str], ...] = ()  # (year, month, day) columns that must be a real date
    unique_key: bool = False  # keep one row per key (the first by all other columns, ascending)


# Reasons, tested in this order; a row gets the first one that applies.
REASON_KEY_MISSING = "key_missing"
REASON_KEY_BLANK = "key_blank"


def _is_text(df: DataFrame | None, column: str) -> bool:
    """Blank tests only make sense on text; a numeric key is never blank."""
    return df is None or isinstance(df.schema[column].dataType, StringType)


def _key_ok(df: DataFrame | None, key: str) -> Column:
    k = F.col(key)
    return k.isNotNull() & nonblank(k) if _is_text(df, key) else k.isNotNull()


def _range_value(df: DataFrame | None, column: str) -> Column:
    """Ranges are numeric; a text cell is read with try_cast (unreadable -> NULL)."""
    c = F.col(column)
    return c.try_cast("int") if df is not None and _is_text(df, column) else c


def reject_reason(rules: CleanRules, df: DataFrame | None = None) -> Column:
    """First failing rule of a row as text, NULL when the row is kept."""
    key = F.col(rules.key)
    out = F.when(key.isNull(), F.lit(REASON_KEY_MISSING))
    if _is_text(df, rules.key):
        out = out.when(~nonblank(key), F.lit(REASON_KEY_BLANK))
    for c in rules.required:
        out = out.when(F.col(c).isNull(), F.lit(f"missing_{c}"))
    for c, (lo, hi) in rules.ranges.items():
        # NULL fails `between` as well (an unreadable value is out of range)
        out = out.when(~F.coalesce(_range_value(df, c).between(lo, hi), F.lit(False)),
                       F.lit(f"out_of_range_{c}"))
    for name, bad in _outliers(rules, df):
        out = out.when(bad, F.lit(name))
    return out


def _outliers(rules: CleanRules, df: DataFrame | None) -> list[tuple[str, Column]]:
    """(reason, test) of the value rules: negative numbers, and dates that do not
    exist though all their parts can be read. NULL and unreadable cells pass."""
    out = [(f"negative_{c}", F.coalesce(_number(df, c) < 0, F.lit(False))) for c in rules.nonnegative]
    for y, m, d in rules.dates:
        parts = [_range_value(df, c) for c in (y, m, d)]
        read = parts[0].isNotNull() & parts[1].isNotNull() & parts[2].isNotNull()
        out.append((f"impossible_date_{y}_{m}_{d}", read & date_from_parts(*parts).isNull()))
    return out


def _number(df: DataFrame | None, column: str) -> Column:
    c = F.col(column)
    return c.try_cast("double") if df is not None and _is_text(df, column) else c


def keep_predicate(rules: CleanRules, df: DataFrame | None = None) -> Column:
    cond = _key_ok(df, rules.key)
    for c in rules.required:
        cond = cond & F.col(c).isNotNull()
    for c, (lo, hi) in rules.ranges.items():
        cond = cond & _range_value(df, c).between(lo, hi)
    for _, bad in _outliers(rules, df):
        cond = cond & ~bad
    return cond


def dedup_full_row(df: DataFrame, key: str | None = None) -> DataFrame:
    """Drop exact duplicate rows (partial aggregation collapses copies map-side).

    With ``key`` (a column of many values) rows are exchanged once by it: equal
    rows share it, and what follows per key needs no further exchange."""
    return (df.repartition(F.col(key)) if key else df).dropDuplicates()


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """The first row of each key by all other columns, ascending, NULL last."""
    return dedup_by_key(df, key, [F.asc_nulls_last(c) for c in df.columns if c != key])


def require_keys(df: DataFrame, key: str, *others: str) -> DataFrame:
    """Reject rows with a NULL or blank key, or NULL in any other listed column."""
    cond = _key_ok(df, key)
    for c in others:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


def year_range(df: DataFrame, column: str, lo: int, hi: int) -> DataFrame:
    """Keep rows with lo <= column <= hi (inclusive; NULL or unreadable rejected)."""
    return df.where(_range_value(df, column).between(lo, hi))


def trim_codes(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.trim(F.col(c)) for c in columns})


def type_columns(df: DataFrame, types: dict[str, str] | None) -> DataFrame:
    """try_cast the listed text columns (unreadable -> NULL), others unchanged."""
    if not types:
        return df
    return df.withColumns({c: F.trim(F.col(c)).try_cast(t) for c, t in types.items()})


def clean(df: DataFrame, rules: CleanRules, types: dict[str, str] | None = None,
          distinct: bool = False) -> DataFrame:
    """Duplicates on the raw rows (skipped if they are known ``distinct``), then
    typing of the listed columns, then the rules, then trims, then one row per
    key where the rules ask for it."""
    typed = type_columns(df if distinct else dedup_full_row(df), types)
    out = typed.where(keep_predicate(rules, typed))
    out = trim_codes(out, *rules.trim) if rules.trim else out
    return one_per_key(out, rules.key) if rules.unique_key else out


def with_reject_reason(df: DataFrame, rules: CleanRules, name: str = "reject_reason") -> DataFrame:
    return df.withColumn(name, reject_reason(rules, df))


def with_copies(df: DataFrame) -> DataFrame:
    """Distinct rows with ``_copies``, how often each came: what both the cleaning
    and its report start from."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))


def clean_report(df: DataFrame, rules: CleanRules, table_name: str,
                 types: dict[str, str] | None = None, columns: Callable | None = None) -> DataFrame:
    """One row: raw, duplicate, rejected-by-reason and kept counts.

    Each reason is counted on its own (duplicates on the raw rows, reasons on
    the distinct rows), so raw = duplicates + rejects + kept. One grouping pass
    counts copies per distinct row, one global aggregate sums it up. ``df`` may be
    ``with_copies`` already; ``columns`` derives the columns that the rules read
    from the distinct source rows.
    """
    copies = df if "_copies" in df.columns else with_copies(df)
    copies = type_columns(columns(copies) if columns else copies, types)
    reason = reject_reason(rules, copies)
    n_range = F.lit(False)
    for c, (lo, hi) in rules.ranges.items():
        n_range = n_range | ~F.coalesce(_range_value(copies, c).between(lo, hi), F.lit(False))
    n_required = F.lit(False)
    for c in rules.required:
        n_required = n_required | F.col(c).isNull()
    key_bad = ~F.coalesce(_key_ok(copies, rules.key), F.lit(False))
    raw_rows = F.coalesce(F.sum("_copies"), F.lit(0))   # an empty table reports zeros
    zero = F.lit(0).cast("bigint")
    kept = F.when(reason.isNull(), F.trim(rules.key) if _is_text(copies, rules.key) else F.col(rules.key))
    repeated = (count_where(reason.isNull()) - F.count_distinct(kept)) if rules.unique_key else zero
    return copies.agg(
        F.lit(table_name).alias("table_name"),
        raw_rows.cast("bigint").alias("raw_rows"),
        (raw_rows - F.count(F.lit(1))).cast("bigint").alias("duplicate_rows"),
        F.coalesce(count_where(key_bad), zero).alias("rejected_key"),
        F.coalesce(count_where(~key_bad & n_required), zero).alias("rejected_required"),
        F.coalesce(count_where(~key_bad & ~n_required & n_range), zero).alias("rejected_range"),
        F.coalesce(count_where(~key_bad & ~n_required & ~n_range & reason.isNotNull()), zero).alias("rejected_outlier"),
        F.coalesce(repeated, zero).cast("bigint").alias("rejected_repeated_key"),
        F.coalesce(count_where(reason.isNull()) - repeated, zero).cast("bigint").alias("kept_rows"),
    )


def dedup_by_key(df: DataFrame, key: str | list[str], order: list[Column]) -> DataFrame:
    """Keep one row per key: the first by ``order`` (which must end in a unique
    tie-break for a deterministic result). ``row_number() == 1`` lets Spark add
    a partial per-key limit before the shuffle, so a hot key ships one row per
    map task."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def na_drop_fill(df: DataFrame, drop_subset: list[str] | None = None,
                 fill: dict[str, object] | None = None) -> DataFrame:
    """``na.drop`` on a subset, then ``na.fill`` with per-column values."""
    out = df.na.drop(subset=drop_subset) if drop_subset else df
    return out.na.fill(fill) if fill else out


def flag_hour_out_of_day(hour: str | Column) -> Column:
    """True when a shape-valid hour is not a real hour (24..99)."""
    h = col_of(hour)
    return h.isNotNull() & ((h < 0) | (h > 23))


def hour_quality(df: DataFrame, hrmn: str = "hrmn", hour: str = "heure_int") -> DataFrame:
    """Quality of the time field: rows, missing text, text of the wrong shape
    (no hour derived), shape-valid but impossible hours (24..99, kept by the
    shape rule and flagged here)."""
    t, h = F.col(hrmn), F.col(hour)
    return df.agg(F.count(F.lit(1)).alias("nb_lignes"),
                  count_where(t.isNull()).alias("heure_absente"),
                  count_where(t.isNotNull() & h.isNull()).alias("heure_mal_formee"),
                  count_where(flag_hour_out_of_day(h)).alias("heure_hors_journee"))
