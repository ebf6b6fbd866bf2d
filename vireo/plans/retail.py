"""Retail exploration — K08: the composite the reference runs over invoice
lines, as one function returning lazy frames (nothing is collected)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo.operators import aggregate as agg
from vireo.operators import project
from vireo.operators.window import range_partitions, running_sum
from vireo.plans.standins import money


def explore(lines: DataFrame, years: Sequence[int], parts: int | None = None) -> dict[str, DataFrame]:
    """``lines`` has description, quantity, price, invoicedate, country.
    ``years`` is the explicit pivot value list (no extra distinct job).
    ``parts`` is the number of partitions in which lines are told apart."""
    # shuffled first: before a shuffle, a task would hold all lines of a read split to find the few that repeat there
    dedup = project.dedup_rows(lines.repartition(range_partitions(lines.sparkSession, parts), *lines.columns))
    flagged = project.null_flag(dedup, "description", "descnull")
    dated = dedup.withColumns({"yr": F.year("invoicedate"), "mnth": F.month("invoicedate"),
                               "dy": F.dayofmonth("invoicedate")})
    revenue = money("quantity") * money("price")
    by_country = dated.groupBy("country").agg(F.sum(revenue).alias("revenue"))
    by_country_item = dated.groupBy("country", "description").agg(F.sum(revenue).alias("revenue"))
    pivot = project.pivot(dated, ["country"], "yr", list(years), F.sum("quantity"))
    year_cols = [str(y) for y in years]
    return {
        "dedup": dedup,
        "description_nulls": flagged.where("descnull = 1").agg(F.count(F.lit(1)).alias("nulls")),
        "country_revenue": by_country,
        "country_means": dated.groupBy("country").agg(F.avg("quantity").alias("avg_quantity"),
                                                      F.avg("price").alias("avg_price")),
        "country_item_pairs": dated.select("country", "description").distinct()
                                   .agg(F.count(F.lit(1)).alias("pairs")),
        "pivot_year_quantity": pivot,
        "unpivot_year_quantity": project.unpivot(pivot, ["country"], year_cols, "yr", "quantity"),
        "cube": agg.cube(dated, ["country", "yr", "mnth"], [F.sum(revenue).alias("revenue")]),
        "rollup": agg.rollup(dated, ["country", "yr", "mnth"], [F.sum(revenue).alias("revenue")]),
        "grouping_sets": agg.grouping_sets(dated, [["country", "yr"], ["yr", "mnth"]], ["country", "yr", "mnth"],
                                           [F.sum(revenue).alias("revenue")]),
        "running_by_country": running_sum(by_country_item, "revenue", "revenue", "cumrevenue",
                                          partition_by=["country"]),
    }
