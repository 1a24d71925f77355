"""The jobs: create a project, run its indicators, build the report.

Each job covers all scenarios of its tables. The only hand-offs are tables on the shared file system.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from scenlens.functions.fixed_values import (
    DB_PREFIX,
    FINAL_REPORT_YEAR,
    FOOD_ITEMS,
    PROJECT_SUFFIX,
    REPORT_SECTORS,
    SSPS,
)
from scenlens.functions.scalars import deflator
from scenlens.operators.spatial import point_in_polygon
from scenlens.plans import compare, economy, food, health, land, water
from scenlens.sources import versions
from scenlens.sources.bucketed import copartitioned, is_bucketed, read_bucketed, register_bucketed
from scenlens.sources.catalog import CATALOG, read_query, register_title, rewrite_labels, where_catalog
from scenlens.sources.files import read_indicator
from scenlens.sources.shared import delete_scope, literal_table, scope, staged


@dataclass(frozen=True)
class Lookups:
    """Inputs that are not query tables.

    ``price_index``: year -> price index. ``multiplier``: region, energy_mult. ``observed_food``: region,
    av_food_exp. ``food_groups``: supplysector, subsector; the fixed list if None. Health and land inputs
    may be absent, then these indicators are not run. Without ``cell_map`` the grid's cells are placed in the
    polygons of ``polygon_edges`` (poly_id, x1, y1, x2, y2), in search cells of ``polygon_cell`` degrees,
    which are split where more than ``polygon_crowd`` edges meet.
    """

    price_index: Mapping[int, float]
    multiplier: DataFrame
    observed_food: DataFrame
    food_groups: DataFrame | None = None
    pm25: DataFrame | None = None
    o3: DataFrame | None = None
    wide_pop: DataFrame | None = None
    macro_regions: DataFrame | None = None
    model_regions: DataFrame | None = None
    health_years: Sequence[int] = ()
    grid: DataFrame | None = None
    grid_members: Sequence[str] = ()
    cell_map: DataFrame | None = None
    polygon_edges: DataFrame | None = None
    polygon_cell: float = 0.5
    polygon_crowd: int | None = 256
    ecoregions: DataFrame | None = None
    ecoregion_names: DataFrame | None = None
    factors: DataFrame | None = None


def food_groups(spark: SparkSession) -> DataFrame:
    """The fixed food items and their demand sectors: (supplysector, subsector)."""
    pairs = [(g, item) for g, items in FOOD_ITEMS.items() for item in items]
    return literal_table(spark, pairs, "supplysector string, subsector string")


def create_project(
    root: str, tables: Mapping[str, DataFrame], raw: bool = False, mode: str = "errorifexists", buckets: int | None = None
) -> None:
    """Register a table per title.

    ``raw`` tables are model rows, to which the title's filter and label merging apply. With ``buckets`` the
    tables are dealt by region and year, so that the indicators' joins need no shuffle; see ``bucketed``.
    """
    for title, df in tables.items():
        if raw:
            query = CATALOG[title]
            df = where_catalog(df, title).select(*[f"`{c}`" for c in query.schema.names])
            if query.relabel:
                df = rewrite_labels(df, *query.relabel)
        if buckets is None:
            register_title(root, title, df, mode)
        else:
            register_bucketed(df.sparkSession, root, title, df, buckets)


def read_title(spark: SparkSession, root: str, title: str, scenarios: Sequence[str] | None = None) -> DataFrame:
    """A project's title, however it is stored."""
    read = read_bucketed if is_bucketed(spark, root, title) else read_query
    return read(spark, root, title, scenarios)


def indicators(
    spark: SparkSession,
    project_root: str,
    base_root: str,
    ssp: str,
    lookups: Lookups,
    final_year: int = FINAL_REPORT_YEAR,
    scenarios: Sequence[str] | None = None,
    details: bool = False,
    consumer: str = "all",
    faithful: bool = False,
    m2_per_factor_unit: float = 1.0,
) -> dict[str, DataFrame]:
    """Every indicator of a project. ``ssp='base'`` evaluates the baseline project itself.

    ``consumer``, ``faithful`` and ``m2_per_factor_unit`` are the choices of the food and land indicators.

    ``details`` adds the regional and household tables behind the world values. These are then staged, as
    several results read them.
    """

    def table(title: str) -> DataFrame:
        return read_title(spark, project_root, title, scenarios)

    index = lookups.price_index
    pop, gdp = table("population by region"), table("GDP per capita PPP by region")
    prices = table("food demand prices by income group")
    income = economy.income_by_decile(
        read_title(spark, base_root, "subregional income"), ssp, final_year, keep_scenario=ssp == "base"
    )
    energy = economy.energy_share(
        table("building service costs"),
        table("building service output by service"),
        pop,
        lookups.multiplier,
        income,
        deflator(index, 1990, 1975),
    )
    eaten = economy.food_share(
        prices,
        table("food demand by income group"),
        pop,
        lookups.observed_food,
        income,
        deflator(index, 1990, 2005),
    )
    if details:
        energy, eaten = staged(energy, "energy_share"), staged(eaten, "food_share")
    bill = food.food_basket_regional(
        table("food consumption by type (specific)"),
        food_groups(spark) if lookups.food_groups is None else lookups.food_groups,
        pop,
        prices,
        consumer,
    )
    share = food.food_basket_pct_gdp(bill, gdp, deflator(index, 2005, 1990), faithful)
    if details:
        share = staged(share, "food_regional")
    supply = water.water_supply(
        table("Basin level available runoff"), table("resource supply curves")
    )
    withdrawal = water.water_withdrawal(
        table("Water Withdrawals by Basin (Runoff)"),
        table("Water Withdrawals by Basin (Groundwater)"),
    )
    scarcity = water.water_scarcity(supply, withdrawal)
    out = {
        "population": economy.population(pop),
        "gdp": economy.gdp_per_capita(gdp),
        "expenditure": economy.basic_needs_world(eaten, energy, pop),
        "food": food.food_basket_pct_gdp_world(share, pop),
        "water": scarcity,
    }
    if details:
        out |= {
            "population_weights": economy.population_weights(pop),
            "energy_share": energy,
            "food_share": eaten,
            "total_share": economy.total_expenditure_share(eaten, energy),
            "food_regional": share,
            "water_runoff": water.water_scarcity_runoff(scarcity),
        }
    if (lookups.pm25 is None) != (lookups.o3 is None):
        raise ValueError("health needs both pollutants, pm25 and o3")
    if lookups.pm25 is not None:
        deaths = staged(health.deaths_by_cause(lookups.pm25, lookups.o3), "deaths")
        shares = health.country_shares(lookups.wide_pop, lookups.macro_regions)
        out["health"] = health.health(
            deaths, shares, lookups.model_regions, lookups.health_years, final_year
        )
    if lookups.grid is not None:
        areas = land.ecoregion_areas(
            land.grid_periods(lookups.grid, lookups.grid_members),
            _cell_map(lookups),
            lookups.ecoregions,
            lookups.ecoregion_names,
            scenarios,
        )
        loss = staged(land.species_loss(areas, lookups.factors, m2_per_factor_unit, faithful), "species_loss")
        out["land"] = loss.select("scenario", F.col("final_PSL").alias("value"))
        out["species_loss"] = loss
    return out


def _cell_map(lookups: Lookups) -> DataFrame:
    """The polygon of each grid cell: given, or from the polygons' edges, written once."""
    if lookups.cell_map is not None:
        return lookups.cell_map
    if lookups.polygon_edges is None:
        raise ValueError("land needs cell_map or polygon_edges")
    cells = lookups.grid.select("lon", "lat").distinct()
    placed = point_in_polygon(
        cells, lookups.polygon_edges, lookups.polygon_cell, ("lon", "lat"), "lon", "lat", crowd=lookups.polygon_crowd
    )
    return staged(placed.withColumnRenamed("poly_id", "OBJECTID"), "cell_map")


_HOUSEHOLD = "scenario string, region string, decile double, year int"

# Columns of the stored indicators; those after ``land`` are details.
STORED: dict[str, str] = {
    "population": "scenario string, region string, Units string, year int, value double",
    "gdp": "scenario string, region string, Units string, year int, value double",
    "expenditure": "scenario string, year int, total_expenditure_per_world double",
    "food": "year int, scenario string, units string, expenditure_percent_GDP double",
    "health": "scenario string, model_region string, year int, mort double",
    "water": "scenario string, year int, resource string, index_sup double, index_wd double",
    "land": "scenario string, value double",
    "species_loss": (
        "scenario string, forest_PSL double, pasture_PSL double, crop_irr_PSL double, crop_rfd_PSL double, "
        "final_PSL double"
    ),
    "population_weights": "scenario string, region string, year int, wpop double",
    "energy_share": f"{_HOUSEHOLD}, energy_expenditure_per double",
    "food_share": f"{_HOUSEHOLD}, food_expenditure_per double",
    "total_share": (
        f"{_HOUSEHOLD}, food_expenditure_per double, energy_expenditure_per double, "
        "total_expenditure_per double"
    ),
    "food_regional": (
        "region string, year int, scenario string, expenditure_percent_GDP double, units string"
    ),
    "water_runoff": "scenario string, year int, resource string, index_wd double",
}


def project_label(file_name: str) -> str:
    """Project label of a project file: without database prefix and extension."""
    return file_name.removeprefix(DB_PREFIX).removesuffix(PROJECT_SUFFIX)


def run_indicators(
    spark: SparkSession,
    project_root: str,
    base_root: str,
    out_root: str,
    project: str,
    ssp: str,
    lookups: Lookups,
    **options,
) -> None:
    """Compute and store every indicator of a project. Readers see all of them at once, or the state before."""
    try:
        with scope("indicators"), copartitioned(spark):
            results = indicators(spark, project_root, base_root, ssp, lookups, **options)
            versions.commit(spark, out_root, project_label(project), {n: shaped(n, df) for n, df in results.items()})
    finally:
        delete_scope(spark, "indicators")  # what is stored stays


def shaped(name: str, df: DataFrame) -> DataFrame:
    """An indicator in the columns that are stored; those it lacks are null."""
    fields = StructType.fromDDL(STORED[name]).fields
    return df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def _rows(spark: SparkSession, out_root: str, name: str, project: str | None) -> DataFrame:
    """From the projects' manifests; from one folder per indicator where an earlier job has written that."""
    read = versions.read if versions.exists(spark, out_root) else read_indicator
    return read(spark, out_root, name, StructType.fromDDL(STORED[name]), project)


def stored(spark: SparkSession, out_root: str, name: str, project: str | None = None) -> DataFrame:
    """A stored indicator of all projects, or of those whose label matches a regex."""
    return _rows(spark, out_root, name, project).drop("project")


def is_stored(spark: SparkSession, out_root: str, name: str) -> bool:
    if versions.exists(spark, out_root):
        return any(name in m.tables for m in versions.all_latest(spark, out_root))
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{out_root}/{name}/indiv_results")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def gather_family(spark: SparkSession, out_root: str, name: str, ssp: str, base_pattern: str = "base") -> DataFrame:
    """A stored indicator of one family's projects, without baseline projects; equal rows once."""
    rows = _rows(spark, out_root, name, ssp)
    return rows.filter(~F.col("project").rlike(base_pattern)).drop("project").distinct()


def gather_reference(spark: SparkSession, out_root: str, name: str, base_pattern: str = "base") -> DataFrame:
    """A stored indicator of the baseline projects."""
    return stored(spark, out_root, name, base_pattern)


def build_report(
    spark: SparkSession,
    out_root: str,
    ssps: Sequence[str] = SSPS,
    sectors: Sequence[str] = REPORT_SECTORS,
    **window,
) -> DataFrame:
    """The wide report over all stored projects, baselines included.

    Health and land may not be stored; ``window`` (y0, y1, base_pattern) sets the report's years and baseline.
    """
    names = {"gdp": "gdp", "pop": "population", "expenditure": "expenditure", "food": "food",
             "health": "health", "water": "water", "land": "land"}
    optional = [n for n in ("health", "land") if not is_stored(spark, out_root, n)]
    tables = {arg: None if name in optional else stored(spark, out_root, name) for arg, name in names.items()}
    differences = compare.report_differences(**tables, ssps=ssps, **window)
    return compare.deliverable(differences, ssps, sectors)
