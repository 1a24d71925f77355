"""Cost of the food basket per person and as a share of GDP."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from scenlens.functions import aggregates as A
from scenlens.functions.fixed_values import (
    DAYS_PER_YEAR_FOOD,
    KCAL_PER_MCAL,
    PCAL_TO_KCAL,
    THOUSAND,
)
from scenlens.functions.scalars import deflate, pct
from scenlens.operators.joins import left_join


def food_basket_regional(
    consumption: DataFrame,
    groups: DataFrame,
    pop: DataFrame,
    price: DataFrame,
    consumer: str = "all",
) -> DataFrame:
    """Food bill in dollars per person and day: (region, scenario, year, expenditure).

    ``groups`` maps a food item (``subsector``) to its demand sector (``supplysector``). An item without
    a group has no price, which leaves the whole region's bill unknown. ``consumer='all'`` adds up the
    prices of all income groups, as existing published results do; ``'median'`` takes their median, the
    documented median consumer (exact, so an income group's prices of one sector, region and year meet in one
    task: as many rows as there are income groups).
    """
    if consumer not in ("all", "median"):
        raise ValueError(f"unknown consumer: {consumer!r}")
    items = consumption.select("region", "scenario", "technology", "year", "value")
    grouped = left_join(items, groups.withColumnRenamed("subsector", "technology"), ["technology"])
    persons = pop.select("year", "scenario", "region", (F.col("value") * THOUSAND).alias("persons"))
    eaten = (
        left_join(grouped, persons, ["year", "scenario", "region"])
        .withColumn(
            "kcal",
            F.try_divide(
                F.col("value") * PCAL_TO_KCAL, F.col("persons") * F.lit(float(DAYS_PER_YEAR_FOOD))
            ),
        )
        .groupBy("region", "scenario", "year", "supplysector")
        .agg(A.sum_strict("kcal").alias("consumption"))
    )
    paid = A.sum_strict("value") if consumer == "all" else A.median_strict("value")
    prices = price.groupBy("region", "scenario", F.col("input").alias("supplysector"), "year").agg(
        (paid / KCAL_PER_MCAL).alias("price")
    )
    # An ungrouped item has a null sector, and a null sector may be priced.
    priced = left_join(eaten, prices, ["region", "year", "supplysector", "scenario"], null_keys=True)
    return priced.groupBy("region", "scenario", "year").agg(
        A.weighted_sum_of("consumption", "price").alias("expenditure")
    )


def food_basket_pct_gdp(
    bill: DataFrame, gdp: DataFrame, deflator_2005_1990: float, faithful: bool = False
) -> DataFrame:
    """The bill in percent of GDP per person: (region, year, scenario, expenditure_percent_GDP, units).

    GDP is converted from thousand 1990 to 2005 dollars per person, and per day like the bill.
    ``faithful`` divides by the price-index ratio alone, as existing published results do.
    """
    on = ["scenario", "region", "year"]
    if faithful:
        value = F.lit(float(deflator_2005_1990))
    else:
        value = deflate(F.col("value") * THOUSAND / DAYS_PER_YEAR_FOOD, deflator_2005_1990)
    per_person = gdp.select(*on, value.alias("GDP"))
    return left_join(bill, per_person, on).select(
        "region",
        "year",
        "scenario",
        pct("expenditure", "GDP").alias("expenditure_percent_GDP"),
        F.lit("percentage").alias("units"),
    )


def food_basket_pct_gdp_world(share: DataFrame, pop: DataFrame) -> DataFrame:
    """Population-weighted world share: (year, scenario, units, expenditure_percent_GDP).

    The weights' denominator is the whole population table, also where a region has no bill. Sums are
    taken before the two sides meet on (year, scenario).
    """
    persons = pop.select("region", "year", "scenario", F.col("value").alias("pop"))
    weighted = (
        left_join(share, persons, ["region", "year", "scenario"])
        .groupBy("year", "scenario", "units")
        .agg(A.weighted_sum_of("expenditure_percent_GDP", "pop").alias("weighted"))
    )
    world = persons.groupBy("year", "scenario").agg(A.sum_strict("pop").alias("world_pop"))
    return left_join(weighted, world, ["year", "scenario"]).select(
        "year",
        "scenario",
        "units",
        F.try_divide(F.col("weighted"), F.col("world_pop")).alias("expenditure_percent_GDP"),
    )
