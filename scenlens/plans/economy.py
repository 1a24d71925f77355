"""Population, GDP per person and the household spending share on basic needs.

Tables are the long query tables of ``sources.catalog``. Two of their names are shortened here: ``consumer``
is the consumer label, whose number is the income decile.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from scenlens.functions import aggregates as A
from scenlens.functions.fixed_values import (
    CALIBRATION_YEAR,
    DAYS_PER_YEAR,
    DECILE_PERSONS,
    DECILE_SHARE,
    FINAL_REPORT_YEAR,
    GJ_TO_EJ,
    INCOME_CORRECTION,
    MCAL_TO_PCAL,
    REPORT_YEARS,
    THOUSAND,
    USD1990_PER_USD2020,
)
from scenlens.functions.scalars import deflate, parse_number, pct
from scenlens.operators.aggregation import calibrate, share_of_total
from scenlens.operators.joins import left_join, natural_inner_join, strict_left_join
from scenlens.operators.rows import between_years, isin_years, match_rows, patch_value, scale


def population(pop: DataFrame) -> DataFrame:
    return pop


def gdp_per_capita(gdp: DataFrame) -> DataFrame:
    return gdp


def population_weights(pop: DataFrame) -> DataFrame:
    """Each region's share of the scenario's population: (scenario, region, year, wpop)."""
    persons = scale(pop.select("scenario", "region", "year", "value"), "value", THOUSAND)
    return share_of_total(persons, ["scenario", "year"], "value", "wpop").drop("value")


def gdp_per_capita_world(gdp: DataFrame, pop: DataFrame) -> DataFrame:
    """Population-weighted world GDP per person in thousand dollars: (scenario, year, GDPpc_thous)."""
    persons = pop.select("scenario", "region", "year", (F.col("value") * THOUSAND).alias("pop"))
    total = strict_left_join(
        gdp.select("scenario", "region", "year", "value"), persons, ["scenario", "region", "year"]
    ).withColumn("gdp", F.col("value") * THOUSAND * F.col("pop"))
    return total.groupBy("scenario", "year").agg(
        (A.ratio_of_sums_of("gdp", "pop") / THOUSAND).alias("GDPpc_thous")
    )


def income_by_decile(
    income: DataFrame,
    ssp: str,
    final_year: int = FINAL_REPORT_YEAR,
    keep_scenario: bool = False,
    corrections: dict[str, float] = INCOME_CORRECTION,
) -> DataFrame:
    """Income per person of the baseline project: ([scenario,] region, decile, year, income).

    ``income`` is the baseline project's table. The scenario is kept only when the baseline itself is
    evaluated; other runs are measured against the baseline's income.
    """
    rows = between_years(match_rows(income, "scenario", ssp), hi=final_year)
    rows = match_rows(rows, "consumer", "resid")
    keys = (["scenario"] if keep_scenario else []) + ["region"]
    rows = rows.select(
        *keys,
        parse_number("consumer").alias("decile"),
        "year",
        (F.col("value") * THOUSAND).alias("income"),
    )
    for region, divisor in corrections.items():
        rows = patch_value(rows, "income", F.col("region") == region, F.col("income") / divisor)
    return rows


def _persons_per_decile(pop: DataFrame) -> DataFrame:
    return pop.select("scenario", "region", "year", (F.col("value") * DECILE_PERSONS).alias("pop"))


def _income_keys(income: DataFrame) -> list[str]:
    return [k for k in ("scenario", "region", "decile", "year") if k in income.columns]


def energy_share(
    price: DataFrame,
    output: DataFrame,
    pop: DataFrame,
    multiplier: DataFrame,
    income: DataFrame,
    deflator_1990_1975: float,
    years: tuple[int, ...] = REPORT_YEARS,
) -> DataFrame:
    """Percent of income spent on home energy: (scenario, region, decile, year, energy_expenditure_per).

    A service without output in a report year counts as zero demand. That needs no completed demand
    table: the prices are the left side of the join, so coalescing its result covers the same cells.
    """
    on = ["scenario", "region", "sector", "year"]
    cost = isin_years(price, years).select(
        *on, (deflate("value", deflator_1990_1975) * GJ_TO_EJ).alias("cost")
    )
    demand = output.select(*on, F.col("value").alias("demand"))
    spent = match_rows(left_join(cost, demand, on), "sector", "resid").select(
        "scenario",
        "region",
        "year",
        parse_number("sector").alias("decile"),
        (F.coalesce("demand", F.lit(0.0)) * F.col("cost")).alias("spent"),
    )
    per_decile = spent.groupBy("scenario", "region", "decile", "year").agg(
        A.sum_strict("spent").alias("spent")
    )
    per_person = strict_left_join(
        per_decile, _persons_per_decile(pop), ["scenario", "region", "year"]
    )
    scaled = strict_left_join(per_person, multiplier.select("region", "energy_mult"), ["region"])
    scaled = scaled.withColumn(
        "spent", F.col("energy_mult") * F.try_divide(F.col("spent"), F.col("pop"))
    ).drop("pop", "energy_mult")
    with_income = strict_left_join(scaled, income, _income_keys(income))
    return with_income.select(
        "scenario", "region", "decile", "year", pct("spent", "income").alias("energy_expenditure_per")
    )


def food_share(
    price: DataFrame,
    demand: DataFrame,
    pop: DataFrame,
    observed: DataFrame,
    income: DataFrame,
    deflator_1990_2005: float,
    years: tuple[int, ...] = REPORT_YEARS,
    ref_year: int = CALIBRATION_YEAR,
) -> DataFrame:
    """Percent of income spent on food, calibrated to observed spending in ``ref_year``.

    (scenario, region, decile, year, food_expenditure, food_expenditure_mult, food_mult,
    food_expenditure_per)
    """
    on = ["scenario", "region", "consumer", "nodeinput", "input", "year"]
    to_2020_per_year = MCAL_TO_PCAL * DAYS_PER_YEAR / USD1990_PER_USD2020
    cost = isin_years(price, years).select(
        *on, (deflate("value", deflator_1990_2005) * to_2020_per_year).alias("cost")
    )
    eaten = demand.select(*on, F.col("value").alias("demand"))
    per_decile = (
        strict_left_join(cost, eaten, on)
        .withColumn("decile", parse_number("consumer"))
        .groupBy("scenario", "region", "decile", "year")
        .agg(A.weighted_sum_of("cost", "demand").alias("food_expenditure"))
    )
    per_person = strict_left_join(
        per_decile, _persons_per_decile(pop), ["scenario", "region", "year"]
    ).withColumn("food_expenditure", F.try_divide(F.col("food_expenditure"), F.col("pop")))
    calibrated = calibrate(
        per_person.drop("pop"),
        observed,
        ["scenario", "region"],
        ["region"],
        "food_expenditure",
        "av_food_exp",
        ref_year,
        "food_expenditure_mult",
        "food_mult",
    )
    in_2020 = income.withColumn("income", F.col("income") / USD1990_PER_USD2020)
    with_income = strict_left_join(calibrated, in_2020, _income_keys(income))
    return with_income.withColumn(
        "food_expenditure_per", pct("food_expenditure_mult", "income")
    ).drop("income")


def total_expenditure_share(food: DataFrame, energy: DataFrame) -> DataFrame:
    """Food plus energy share for the households that have both."""
    on = ["scenario", "region", "decile", "year"]
    both = natural_inner_join(
        food.select(*on, "food_expenditure_per"), energy.select(*on, "energy_expenditure_per")
    )
    return both.withColumn(
        "total_expenditure_per", F.col("food_expenditure_per") + F.col("energy_expenditure_per")
    )


def basic_needs_world(food: DataFrame, energy: DataFrame, pop: DataFrame) -> DataFrame:
    """Income share required for basic needs: (scenario, year, total_expenditure_per_world).

    Each household counts with its region's population share, a tenth per decile. The shares are not
    attached to the households first: the population-weighted sum is aggregated, then divided by the
    scenario's population, so nothing joins on the few (scenario, year) keys before it is reduced.
    """
    persons = pop.select("scenario", "region", "year", F.col("value").alias("pop"))
    weighted = (
        strict_left_join(
            total_expenditure_share(food, energy), persons, ["scenario", "region", "year"]
        )
        .groupBy("scenario", "year")
        .agg((A.weighted_sum_of("total_expenditure_per", "pop") * DECILE_SHARE).alias("weighted"))
    )
    world = persons.groupBy("scenario", "year").agg(A.sum_strict("pop").alias("world_pop"))
    return left_join(weighted, world, ["scenario", "year"]).select(
        "scenario",
        "year",
        F.try_divide(F.col("weighted"), F.col("world_pop")).alias("total_expenditure_per_world"),
    )
