"""Premature deaths from air pollution, from macro-regions down to countries and up to model regions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from scenlens.functions import aggregates as A
from scenlens.functions.fixed_values import (
    COUNTRY_AS_REGION,
    FINAL_REPORT_YEAR,
    MERGED_REGION,
    SHARES_SCENARIO,
)
from scenlens.operators.aggregation import share_of_total, sum_by
from scenlens.operators.joins import inner_join, strict_left_join
from scenlens.operators.reshape import duplicate_member, fold_member, union_by_name, unpivot_years
from scenlens.operators.rows import complete_cases, match_rows


def paf_mortality(rates: DataFrame, risk: DataFrame, pop: DataFrame) -> DataFrame:
    """Deaths attributable to exposure: base rate x (RR - 1) / RR x exposed population.

    ``rates``: (region, year, disease, age, rate); ``risk``: (scenario, region, year, disease, age, rr);
    ``pop``: (scenario, region, year, age, exposed). Relative risks are inputs.
    """
    cause = ["region", "year", "disease", "age"]
    at_risk = strict_left_join(risk, rates.select(*cause, "rate"), cause)
    exposed = strict_left_join(
        at_risk, pop.select("scenario", "region", "year", "age", "exposed"),
        ["scenario", "region", "year", "age"],
    )
    fraction = F.try_divide(F.col("rr") - 1, F.col("rr"))
    return exposed.select(
        "scenario",
        "region",
        "year",
        "age",
        "disease",
        (F.col("rate") * fraction * F.col("exposed")).alias("mort"),
    )


def regional_deaths(
    mort: DataFrame, value: str, merged: tuple[str, str] = MERGED_REGION
) -> DataFrame:
    """Deaths of all causes by (scenario, region, year); ``merged`` counts one region under another."""
    rows = mort.select(
        "scenario", "region", F.col("year").try_cast("int").alias("year"), F.col(value).alias("mort")
    )
    return fold_member(rows, "region", *merged, ["scenario", "region", "year"], "mort")


def country_shares(
    wide_pop: DataFrame,
    countries: DataFrame,
    scenario: str = SHARES_SCENARIO,
    as_region: tuple[str, str] = COUNTRY_AS_REGION,
) -> DataFrame:
    """Each country's share of its macro-region's population: (macro_region, country, year, share).

    ``wide_pop``: one column per year (``X2010``, ...) and SCENARIO, REGION, VARIABLE. One scenario's
    shares serve all runs. ``as_region``: a country whose years are copied to a region of its own.
    """
    rows = match_rows(wide_pop, "SCENARIO", scenario).filter(F.col("VARIABLE") == "Population")
    long = complete_cases(unpivot_years(rows, ["SCENARIO", "REGION", "VARIABLE"], "X", "pop"))
    long = long.select(F.col("REGION").alias("country"), "year", "pop")
    placed = strict_left_join(long, countries.select("country", "macro_region"), ["country"])
    shares = share_of_total(placed, ["macro_region", "year"], "pop", "share").drop("pop")
    own, region = as_region
    return duplicate_member(
        shares, F.col("country") == own, macro_region=region, country=region, share=1.0
    ).select("macro_region", "country", "year", "share")


def downscale_mortality(
    mort: DataFrame,
    shares: DataFrame,
    regions: DataFrame,
    years: Sequence[int],
    final_year: int = FINAL_REPORT_YEAR,
) -> DataFrame:
    """Macro-region deaths to model regions: (scenario, [cause,] model_region, year, mort).

    Deaths are split by population share and rounded half-even per country, then summed. ``regions``:
    (country, model_region). Every share needs deaths in every scenario (and cause); rather than crossing
    shares with scenarios, the scenarios per macro-region and year are counted and compared with their
    number. ``mort`` is one row per scenario, region and year, read three times: stage it if it is costly.
    """
    dims = [c for c in mort.columns if c not in ("region", "year", "mort")]
    wanted = shares.filter(F.col("year").isin(*years) & (F.col("year") <= final_year))
    n = mort.select(*dims).distinct().agg(F.count(F.lit(1)).alias("n")).scalar()
    counted = mort.groupBy("region", "year").agg(F.count(F.lit(1)).alias("n_runs"))
    wanted = strict_left_join(
        wanted.withColumnRenamed("macro_region", "region"), counted, ["region", "year"]
    )
    message = F.concat(
        F.lit("a scenario has no deaths for "), F.to_json(F.struct("region", "year"))
    )
    covered = F.when(F.col("n_runs") != n, F.raise_error(message)).otherwise(F.lit(True))
    placed = strict_left_join(
        wanted.filter(covered).drop("n_runs"), regions.select("country", "model_region"), ["country"]
    )
    split = inner_join(placed, mort, ["region", "year"])
    split = split.withColumn("mort", F.bround(F.col("mort") * F.col("share"), 0))
    return sum_by(split, [*dims, "model_region", "year"], "mort")


def total_mortality(*causes: DataFrame) -> DataFrame:
    """Deaths of all pollutants by (scenario, model_region, year)."""
    return sum_by(union_by_name(*causes), ["scenario", "model_region", "year"], "mort")


def deaths_by_cause(
    pm25: DataFrame,
    o3: DataFrame,
    pm25_value: str = "GBD",
    o3_value: str = "Jerret2009",
    merged: tuple[str, str] = MERGED_REGION,
) -> DataFrame:
    """Macro-region deaths of both pollutants: (scenario, cause, region, year, mort)."""
    return union_by_name(
        regional_deaths(pm25, pm25_value, merged).withColumn("cause", F.lit("PM2.5")),
        regional_deaths(o3, o3_value, merged).withColumn("cause", F.lit("O3")),
    )


def health(
    deaths: DataFrame,
    shares: DataFrame,
    regions: DataFrame,
    years: Sequence[int],
    final_year: int = FINAL_REPORT_YEAR,
) -> DataFrame:
    """Deaths from both pollutants by model region; all scenarios and causes in one pass."""
    return total_mortality(downscale_mortality(deaths, shares, regions, years, final_year))
