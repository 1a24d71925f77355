"""Scenarios against their baselines, and the report over all SSP families.

Scenario names read ``<label with sector and Gt>_<ssp>``; a baseline's name contains ``base``. All families
go through one plan: the family is a key, not a loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from scenlens.functions import aggregates as A
from scenlens.functions.fixed_values import (
    FINAL_REPORT_YEAR,
    FIRST_REPORT_YEAR,
    REPORT_SECTORS,
    SECTOR_PRECEDENCE,
    SECTOR_PRECEDENCE_LEGACY,
    SECTOR_PRECEDENCE_LEGACY_LAND,
    SSPS,
)
from scenlens.functions.scalars import diff, sector_of, single_number, split_last
from scenlens.operators.aggregation import sum_by
from scenlens.operators.joins import attach_baseline, attach_scalar
from scenlens.operators.reshape import merge_all_groups, pivot_members, union_by_name
from scenlens.operators.rows import between_years, order_report, sort_numeric, sort_report
from scenlens.plans.economy import gdp_per_capita_world
from scenlens.plans.water import water_scarcity_runoff
from scenlens.sources.shared import staged

IDS = ("unit", "sdg", "Gt_CO2_reduction")


def family_of(scenario: str | Column, ssps: Sequence[str] = SSPS) -> Column:
    """The SSP family a scenario's name mentions; null for none."""
    c = F.col(scenario) if isinstance(scenario, str) else scenario
    return F.coalesce(*[F.when(c.contains(s), F.lit(s)) for s in ssps])


def scenario_parts(
    scenario: str | Column, order: Sequence[str] = SECTOR_PRECEDENCE
) -> tuple[Column, Column, Column]:
    """(Gt_CO2_reduction, sector, ssp) read from a scenario name."""
    head, tail = split_last(scenario, "_")
    return single_number(head), sector_of(scenario, tuple(order)), tail


def measure_rows(
    df: DataFrame, measure: str, unit: str, sdg: str, relative: bool = False
) -> DataFrame:
    """An indicator in comparable form: (scenario, year, unit, sdg, relative, value).

    ``df`` holds (scenario, year, measure), or (scenario, measure) for a measure of the whole run, whose
    year is null.
    """
    year = F.col("year") if "year" in df.columns else F.lit(None)
    return df.select(
        "scenario",
        year.cast("int").alias("year"),
        F.lit(unit).alias("unit"),
        F.lit(sdg).alias("sdg"),
        F.lit(relative).alias("relative"),
        F.col(measure).cast("double").alias("value"),
    )


def mean_differences(
    measures: DataFrame,
    base_pattern: str = "base",
    ssps: Sequence[str] = SSPS,
    y0: int = FIRST_REPORT_YEAR,
    y1: int = FINAL_REPORT_YEAR,
) -> DataFrame:
    """Mean yearly difference from the family's baseline: (scenario, family, unit, sdg, diff).

    ``measures`` are rows of :func:`measure_rows`, of any number of indicators: all are compared in one
    pass. Every row needs exactly one baseline row of its family, indicator and year. Baseline rows number
    at most families x indicators x report years, which is why they may be broadcast.
    """
    family = family_of("scenario", ssps)
    rows = measures.filter(
        family.isNotNull() & (F.col("year").isNull() | F.col("year").between(y0, y1))
    ).withColumns({"family": family, "at": F.coalesce("year", F.lit(0))})
    is_base = F.col("scenario").rlike(base_pattern)
    joined = attach_baseline(rows, is_base, ["family", "sdg", "at"], ["value"], bounded=True)
    change = F.when(F.col("relative"), diff("value", "value_base", relative=True)).otherwise(
        diff("value", "value_base")
    )
    return (
        joined.filter(~is_base)
        .withColumn("diff", change)
        .groupBy("scenario", "family", "unit", "sdg")
        .agg(A.mean_strict("diff").alias("diff"))
    )


def mean_difference(
    df: DataFrame, measure: str, unit: str, sdg: str, relative: bool = False, **window
) -> DataFrame:
    """:func:`mean_differences` of one indicator."""
    return mean_differences(measure_rows(df, measure, unit, sdg, relative), **window)


def scalar_difference(
    df: DataFrame, measure: str, unit: str, sdg: str, family: str, base_pattern: str = "base"
) -> DataFrame:
    """Difference from a family's single baseline value, for measures without years."""
    rows = df.filter(F.col("scenario").contains(family))
    is_base = F.col("scenario").rlike(base_pattern)
    joined = attach_scalar(rows, rows.filter(is_base), {f"{measure}_base": measure})
    return (
        joined.filter(~is_base)
        .withColumn("diff", diff(measure, f"{measure}_base"))
        .groupBy("scenario")
        .agg(A.mean_strict("diff").alias("diff"))
        .select(
            "scenario",
            F.lit(family).alias("family"),
            F.lit(unit).alias("unit"),
            F.lit(sdg).alias("sdg"),
            "diff",
        )
    )


def tagged(diffs: DataFrame, order: Sequence[str] = SECTOR_PRECEDENCE) -> DataFrame:
    """One row per report cell: (unit, sdg, Gt_CO2_reduction, family, sector_ssp, diff).

    A cell goes by its sector and family, wherever in the scenario's name these stand.
    """
    gt, sector, _ = scenario_parts("scenario", order)
    cell = F.concat_ws("_", sector, F.lower("family"))
    return diffs.select(
        "unit", "sdg", gt.alias("Gt_CO2_reduction"), "family", cell.alias("sector_ssp"), "diff"
    )


def report_members(
    ssps: Sequence[str] = SSPS, sectors: Sequence[str] = REPORT_SECTORS
) -> list[str]:
    return [f"{sector}_{ssp.lower()}" for sector in sectors for ssp in ssps]


def compare(
    df: DataFrame,
    measure: str,
    unit: str,
    sdg: str,
    relative: bool = False,
    ssps: Sequence[str] = SSPS,
    sectors: Sequence[str] = (*REPORT_SECTORS, "a"),
    **window,
) -> DataFrame:
    """The wide comparison table of one indicator, all families, by reduction level."""
    cells = tagged(mean_difference(df, measure, unit, sdg, relative, ssps=ssps, **window))
    members = report_members(ssps, sectors)
    return pivot_members(cells, IDS, "sector_ssp", "diff", members)


def compare_legacy(
    df: DataFrame,
    measure: str,
    baseline: str,
    unit: str,
    sdg: str,
    y0: int = FIRST_REPORT_YEAR,
    y1: int = FINAL_REPORT_YEAR,
    order: Sequence[str] = SECTOR_PRECEDENCE_LEGACY,
) -> DataFrame:
    """One project's table: a baseline by exact name, absolute differences, the level after the last '_'."""
    rows = between_years(df, y0, y1)
    is_base = F.col("scenario") == baseline
    joined = attach_baseline(rows, is_base, ["year"], [measure], bounded=True)
    means = (
        joined.filter(~is_base)
        .withColumn("diff", diff(measure, f"{measure}_base"))
        .groupBy("scenario")
        .agg(A.mean_strict("diff").alias("diff"))
    )
    cells = means.select(
        F.lit(unit).alias("unit"),
        F.lit(sdg).alias("sdg"),
        split_last("scenario", "_")[1].alias("Gt_CO2_reduction"),
        sector_of("scenario", tuple(order)).alias("sector"),
        "diff",
    )
    return pivot_members(cells, IDS, "sector", "diff", (*sorted(order), "a"))


def legacy_report(
    baseline: str,
    gdp: DataFrame,
    pop: DataFrame,
    food: DataFrame,
    health: DataFrame,
    water: DataFrame,
    land: DataFrame,
    **window,
) -> DataFrame:
    """One project's report in the older layout: five indicators, one column per sector.

    ``land`` holds (scenario, year, percent_unmanaged); its sector test puts dac first.
    """
    # Measure, unit and name in the report.
    plan = [
        (gdp_per_capita_world(gdp, pop), "GDPpc_thous", "Thous$/pers", "Economy"),
        (food, "expenditure_percent_GDP", "perc_GDP", "Poverty"),
        (sum_by(health, ["scenario", "year"], "mort"), "mort", "Mortalities", "Health"),
        (water_scarcity_runoff(water), "index_wd", "Index", "Water"),
    ]
    blocks = [compare_legacy(df, m, baseline, unit, sdg, **window) for df, m, unit, sdg in plan]
    blocks.append(
        compare_legacy(
            land, "percent_unmanaged", baseline, "%", "Land",
            order=SECTOR_PRECEDENCE_LEGACY_LAND, **window,
        )
    )
    return union_by_name(*blocks)


def deliverable(
    differences: DataFrame,
    ssps: Sequence[str] = SSPS,
    sectors: Sequence[str] = REPORT_SECTORS,
    ordered: bool = True,
) -> DataFrame:
    """All indicators in one wide table: a row per unit, indicator and reduction level.

    ``differences`` are rows of ``mean_differences`` (or ``scalar_difference``), possibly a union of
    several. A level appears only if every family has it for that indicator. Columns are grouped by sector; scenarios without a known sector
    count towards a level's presence but have no column.
    """
    cells = tagged(differences)
    members = report_members(ssps, (*sectors, "a"))
    wide = merge_all_groups(cells, IDS, "family", ssps, "sector_ssp", "diff", members)
    wide = order_report(wide, ["Gt_CO2_reduction", "unit", "sdg"], sectors)
    return sort_report(wide, "sdg", "Gt_CO2_reduction") if ordered else wide


def report_differences(
    gdp: DataFrame,
    pop: DataFrame,
    expenditure: DataFrame,
    food: DataFrame,
    health: DataFrame | None,
    water: DataFrame,
    land: DataFrame | None,
    **window,
) -> DataFrame:
    """Differences of the report's six indicators, from the gathered tables, in one comparison.

    Health and land may be absent. The measures are a small table, written once, as rows and as baselines.
    """
    people = pop.select("scenario", "region", "year", "value").distinct()
    runoff = water_scarcity_runoff(water)
    # Measure, unit, name in the report, and whether the difference is relative.
    plan = [
        (gdp_per_capita_world(gdp, people), "GDPpc_thous", "Thous$/pers", "Economy", True),
        (expenditure, "total_expenditure_per_world", "perc_income", "Poverty", False),
        (food, "expenditure_percent_GDP", "perc_GDP", "Hunger", False),
        (runoff, "index_wd", "Index", "Water", False),
    ]
    if health is not None:
        plan.append((sum_by(health, ["scenario", "year"], "mort"), "mort", "Mortalities", "Health", False))
    if land is not None:
        plan.append((land.select("scenario", "value"), "value", "PSL", "PSL", False))
    measures = staged(union_by_name(*[measure_rows(*block) for block in plan]), "measures")
    return mean_differences(measures, **window)


def sorted_by_level(table: DataFrame) -> DataFrame:
    """A comparison table in order of its reduction levels, for a final output."""
    return sort_numeric(table, "Gt_CO2_reduction")
