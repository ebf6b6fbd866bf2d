"""ABC (Pareto) classification — K04, W01, W02, F09.

The reference orders items *ascending* by the basis column, so class 'A' is
the low-value tail whose running total stays under the first level; the
textbook (descending) form is available with ``descending=True``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vireo.operators.window import band, running_share
from vireo.session import checkpoint_dir

# The reference's class boundaries.
DEFAULT_LEVELS = (0.75, 0.95)


def abc_classify(df: DataFrame, basis: str, cum_col: str, cat_col: str,
                 levels: Sequence[float] = DEFAULT_LEVELS, descending: bool = False,
                 pct_col: str = "cumper", materialize: bool = True) -> DataFrame:
    """Add running total ``cum_col``, its percentage and the class column.

    The running sum reads its input twice (peer totals and the join back), so
    with ``materialize`` the input (an aggregate: one row per item) is
    checkpointed first to the session's checkpoint directory.
    """
    if materialize:
        checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    shared = running_share(df, basis, basis, cum_col, "__share", descending=descending, total_col="__tot")
    cum_d = F.col(cum_col).cast("double")
    tot_d = F.col("__tot").cast("double")
    return (shared
            .withColumn(pct_col, cum_d * 100 / tot_d)
            .withColumn(cat_col, band(cum_d / tot_d, levels))
            .drop("__share", "__tot"))


def abc_summary(classified: DataFrame, basis: str, cat_col: str) -> DataFrame:
    """Per class: item count, basis total, share of the basis, share of items.

    One pass over the items; the grand totals are sums over the classes' rows.
    """
    per = classified.groupBy(cat_col).agg(F.count(F.lit(1)).alias("catcount"), F.sum(basis).alias("catrev"))
    classes = Window.partitionBy()  # one row per class: three
    joined = per.withColumns({"__tot": F.sum("catrev").over(classes), "__n": F.sum("catcount").over(classes)})
    catrevper = F.col("catrev").cast("double") / F.col("__tot").cast("double")
    return joined.select(
        F.col(cat_col).alias("category"),
        F.col("catcount"),
        F.col("catrev").cast("double").alias("catrev"),
        (F.col("catcount") / F.col("__n") * 100).alias("countper"),
        (catrevper * 100).alias("revenueper"),
    )
