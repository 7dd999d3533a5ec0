"""Bounded samples of labelled rows, for models that are trained on the driver."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_sample(rows: DataFrame, label: str, per_label: int) -> pd.DataFrame:
    """About ``per_label`` different rows of each label, and never more than twice that.

    Rows that repeat count and are drawn once. A row is taken if a hash of all its columns
    falls below the label's share; a label with too many keeps those of the smallest
    hashes. So the sample is the same for the same rows, in whatever order they come.
    """
    rows = rows.where(F.col(label).isNotNull())
    mark = F.xxhash64(*rows.columns)
    # counted by hashes, so that texts are not moved
    counts = {r[0]: r[1] for r in rows.select(label, mark.alias("_mark")).distinct().groupBy(label).count().collect()}
    if not counts:
        return rows.limit(0).toPandas()
    spot = F.pmod(mark, F.lit(1 << 30)) / F.lit(float(1 << 30))
    shares = F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, min(1.0, per_label / n))))
    # copies that are drawn become one before they leave their task
    taken = rows.where(spot < F.element_at(shares, F.col(label))).distinct().withColumn("_spot", spot).toPandas()
    kept = taken.sort_values(["_spot", *rows.columns]).groupby(label).head(2 * per_label)
    return kept[rows.columns].sort_values(rows.columns, ignore_index=True)
