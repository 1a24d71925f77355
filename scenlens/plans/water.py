"""Physical water scarcity: withdrawal over renewable supply, weighted over basins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from scenlens.functions import aggregates as A
from scenlens.functions.fixed_values import RUNOFF_YEAR_LIMIT, WATER_BASE_YEAR
from scenlens.operators.joins import inner_join
from scenlens.operators.reshape import union_by_name

_KEYS = ["scenario", "basin", "subresource", "year", "Units"]


def _source(runoff: DataFrame, runoff_basin: str, ground: DataFrame, ground_basin: str, out: str):
    surface = runoff.filter(F.col("year") < RUNOFF_YEAR_LIMIT).select(
        "scenario", F.col(f"`{runoff_basin}`").alias("basin"), "subresource", "year", "Units",
        F.col("value").alias(out),
    )
    below = (
        ground.filter(F.col("subresource").contains("groundwater"))
        .groupBy(
            "scenario",
            F.col(f"`{ground_basin}`").alias("basin"),
            F.lit("groundwater").alias("subresource"),
            "year",
            "Units",
        )
        .agg(A.sum_strict("value").alias(out))
    )
    return union_by_name(surface, below)


def water_supply(runoff: DataFrame, curves: DataFrame) -> DataFrame:
    """Available runoff, and groundwater summed over grades: (..., value_sup)."""
    return _source(runoff, "basin", curves, "resource", "value_sup")


def water_withdrawal(runoff: DataFrame, ground: DataFrame) -> DataFrame:
    """Withdrawn runoff and groundwater: (..., value_wd)."""
    return _source(runoff, "runoff water", ground, "groundwater", "value_wd")


def water_scarcity(
    supply: DataFrame, withdrawal: DataFrame, base_year: int = WATER_BASE_YEAR
) -> DataFrame:
    """(scenario, year, resource, index_sup, index_wd): scarcity weighted by base-year supply and withdrawal.

    A basin takes part if it has both quantities in the base year, whatever their units; a year in which
    the two sides don't meet in unit too has no index, and so leaves the mean missing.
    """
    met = supply.join(withdrawal, _KEYS, "left")
    of = ["basin", "scenario", "subresource"]
    base = F.col("year") == base_year
    weights = inner_join(
        supply.filter(base).select(*of, F.col("value_sup").alias("w_sup")),
        withdrawal.filter(base).select(*of, F.col("value_wd").alias("w_wd")),
        of,
    )
    indexed = met.withColumn("index", F.try_divide(F.col("value_wd"), F.col("value_sup")))
    weighted = inner_join(
        indexed.select("scenario", "basin", "subresource", "year", "index"),
        weights,
        ["basin", "scenario", "subresource"],
    )
    kind = F.when(F.col("subresource") == "runoff", "runoff").when(
        F.col("subresource").isNotNull(), "groundwater"
    )
    return weighted.groupBy("scenario", "year", kind.alias("resource")).agg(
        A.weighted_mean_of("index", "w_sup").alias("index_sup"),
        A.weighted_mean_of("index", "w_wd").alias("index_wd"),
    )


def water_scarcity_runoff(index: DataFrame) -> DataFrame:
    """The headline index: runoff, weighted by withdrawal."""
    return index.filter(F.col("resource") == "runoff").drop("index_sup")
