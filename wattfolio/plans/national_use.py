"""National electricity use: named, filtered tables per usage (C4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattfolio import fixed
from wattfolio.operators import filters
from wattfolio.operators.aggregate import union_all


def use_table(records: DataFrame, names: dict[str, str], start: str = fixed.USE_START) -> DataFrame:
    """Chosen columns under their published names, from ``start`` on."""
    dated = records.withColumn("date", F.to_date("date"))
    return filters.within(dated, "date", start).select(
        *[F.col(old).alias(new) for old, new in names.items()]
    )


def consumption_tables(
    national: DataFrame, final: DataFrame, start: str = fixed.USE_START
) -> DataFrame:
    """Both tables in one, with ``usage`` as key."""
    return union_all(
        [
            use_table(national, fixed.NATIONAL_USE_NAMES, start).withColumn(
                "usage", F.lit("landesverbrauch")
            ),
            use_table(final, fixed.FINAL_USE_NAMES, start).withColumn(
                "usage", F.lit("endverbrauch")
            ),
        ]
    )
