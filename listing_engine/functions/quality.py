"""Row checks: key check (C2), range validation (C3), quarantine (C4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .scalars import falsy, vkind


# Accepted ranges of the normalised numbers (inclusive); the
# year's upper bound is the reference year + 1 and is passed in.
YEAR_MIN = 1900
PRICE_MAX = 100_000_000
KM_AGE_MAX = 10_000_000
POWER_MAX = 10_000
DISPLACEMENT_MAX = 20


def has_key(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def split_keyless(records: DataFrame, key: str = "inner_id") -> tuple[DataFrame, Observation]:
    """(records with a key, counter).  The count of those without one,
    `keyless`, is observed in the pass that reads the records on:
    `counter.get` has it once that pass has run."""
    counter = Observation()
    missing = F.coalesce(~has_key(F.col(key)), F.lit(True))
    return records.observe(counter, F.count_if(missing).cast("bigint").alias("keyless"), F.count(F.lit(1)).alias("records")) \
        .where(~missing), counter


def reject_reason(current_year: int, key: str = "inner_id") -> Column:
    """NULL when the row passes, else the first failing check.

    A NULL or zero value is not checked (the reference guards every check
    with truthiness), so `"0"` -> 0 passes even where 0 is out of range."""
    def checked(c: str) -> Column:
        return F.col(c).isNotNull() & (F.col(c) != 0)

    return (
        F.when(F.col(key).isNull() | (F.col(key) == ""), F.lit("missing_inner_id"))
        .when(checked("year") & ~F.col("year").between(YEAR_MIN, current_year + 1), F.lit("year"))
        .when(checked("price") & ~F.col("price").between(0, PRICE_MAX), F.lit("price"))
        .when(checked("km_age") & ~F.col("km_age").between(0, KM_AGE_MAX), F.lit("km_age"))
        .when(checked("power") & ~F.col("power").between(0, POWER_MAX), F.lit("power"))
        .when(checked("displacement") & ~F.col("displacement").between(0, DISPLACEMENT_MAX), F.lit("displacement"))
    )


QUARANTINE_CHECKS = ("payload_not_object", "extra_type", "option_type", "option_entry_type",
                     "option_group_type", "option_opts_type")


def quarantine_reason_of(m: Column, extra: Column, extra_kind: Column, option_kind: Column, used: Column,
                         display: Column, groups: Column) -> Column:
    """C4 from values the normaliser already extracted (see
    `scalars.option_entries`): the first failing check, NULL when usable."""
    return (
        F.when(m.isNull(), F.lit("payload_not_object"))
        .when(extra_kind.isin("number", "bool") & ~falsy(extra, extra_kind), F.lit("extra_type"))
        .when(used & option_kind.isin("number", "bool"), F.lit("option_type"))
        .when(used & F.exists(display, lambda e: e["bad"]), F.lit("option_entry_type"))
        .when(used & F.exists(groups, lambda g: g["bad"]), F.lit("option_group_type"))
        .when(used & F.exists(groups, lambda g: F.exists(g["opts"], lambda e: e["bad"])), F.lit("option_opts_type"))
    )
