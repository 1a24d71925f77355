"""Registered queries. Each runs its operator over the whole input tables.

Doubles are rounded on output because sums add up in another order on every run. Means of money columns
come from exact sums and are not rounded: short decimals would be rounding ties.
"""

from __future__ import annotations

from collections.abc import Callable
from math import cos, pi, sin

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, StructType

from scenlens.functions.scalars import project_db_name, project_name, split_first, split_last
from scenlens.operators.aggregation import (
    calibrate,
    mean_by,
    share_of_total,
    sum_by,
    sum_numeric_by,
    weighted_ratio,
)
from scenlens.operators.exact import exact_means, exact_sums
from scenlens.operators.joins import natural_left_join, strict_left_join
from scenlens.operators.reshape import (
    complete,
    duplicate_member,
    fold_member,
    pivot_complete,
    pivot_years,
    two_period,
    union_by_name,
    unpivot_years,
)
from scenlens.operators.open_pivot import pivot_open, widened
from scenlens.operators.ranking import numeric_order, placed, ranked
from scenlens.operators.rows import cols_matching, complete_cases, match_rows, report_order as report_rows_order, strip_prefix, zero_fill
from scenlens.operators.spatial import point_in_polygon
from scenlens.plans import compare as C
from scenlens.plans import economy, food, gather, health, land, run, water
from scenlens.sources import catalog, files, grids, versions
from scenlens.sources.bucketed import copartitioned
from scenlens.sources.grids import Axis
from scenlens.sources.shared import literal_table, new_folder, staged
from scenlens.workload.views import (
    BASELINE,
    DECILES,
    FOOD_TYPES,
    LAND_CLASSES,
    REPORT_FROM,
    REPORT_TO,
    SCENARIOS,
    TYPE_GROUPS,
    YEARS,
    Views,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

CELL = ["scenario", "region", "year"]
WINDOW = dict(y0=REPORT_FROM, y1=REPORT_TO)


def query(digits: int | None = 6):
    """Register a function of the views; its double columns are rounded to ``digits``."""

    def register(fn: Callable[[Views], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(Views(spark, sf_dir))
            doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, DoubleType)]
            if digits is None or not doubles:
                return df
            return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in doubles})

        QUERIES[fn.__name__] = run
        return fn

    return register


# Population, GDP, weights ------------------------------------------------------------------------


@query()
def population(v: Views) -> DataFrame:
    return economy.population(v.pop())


@query(None)
def gdp_per_capita(v: Views) -> DataFrame:
    return economy.gdp_per_capita(v.gdp())


@query(8)
def population_weights(v: Views) -> DataFrame:
    return economy.population_weights(staged(v.pop(), "pop"))


@query()
def gdp_per_capita_world(v: Views) -> DataFrame:
    return economy.gdp_per_capita_world(v.gdp(), v.pop())


# Catalog -----------------------------------------------------------------------------------------


@query(4)
def label_rewrite(v: Views) -> DataFrame:
    rows = catalog.rewrite_labels(v.lines().select("technology", "demand"), "technology", TYPE_GROUPS)
    return sum_by(rows, ["technology"], "demand")


@query(4)
def label_rewrite_table(v: Views) -> DataFrame:
    """The mapping as a table: each nation's label is its region's name, but for one region."""
    mapping = v.nations().filter(F.col("super_key") != 0).select("region", "super_region")
    rows = catalog.rewrite_labels(v.obs().select("region", "value"), "region", mapping)
    return sum_by(rows, ["region"], "value")


@query(4)
def member_filter_emissions(v: Views) -> DataFrame:
    rows = v.service().select("scenario", F.col("technology").alias("GHG"), "year", "demand")
    kept = catalog.emissions(
        rows, ("SMALL", "LARGE", "PROMO", "MEDIUM"), ("BUILDING", "MACHINERY"), mapping=TYPE_GROUPS
    )
    return sum_by(kept, ["scenario", "GHG", "year"], "demand")


@query(4)
def catalog_predicate(v: Views) -> DataFrame:
    """Rows of a title by its catalog filter: the statuses stand for the water sources."""
    source = F.when(F.col("status") == "O", "runoff").otherwise("groundwater")
    rows = v.service(part=False).select(
        "scenario",
        "year",
        F.concat(F.col("region"), F.lit("_water withdrawals")).alias("resource"),
        source.alias("subresource"),
        "demand",
    )
    kept = catalog.where_catalog(rows, "Basin level available runoff")
    return sum_by(kept, ["scenario", "resource", "subresource", "year"], "demand")


def _fine_titles(v: Views) -> DataFrame:
    """(title, scenario) pairs with titles so fine that many lack some scenario."""
    return v.obs().select(F.concat_ws("/", "title", "region", "year", "decile").alias("title"), "scenario")


@query(None)
def query_coverage(v: Views) -> DataFrame:
    return catalog.query_coverage(_fine_titles(v))


@query(None)
def missing_titles(v: Views) -> DataFrame:
    titles = _fine_titles(v)
    return catalog.missing_titles(titles, titles.select("title").distinct(), in_all=True)


@query(None)
def list_scenarios(v: Views) -> DataFrame:
    return catalog.list_scenarios(v.runs())


@query(4)
def check_scenarios(v: Views) -> DataFrame:
    rows = catalog.check_scenarios(v.obs().select("scenario", "value"), ["BUILDING", "FURNITURE"])
    return sum_by(rows, ["scenario"], "value")


@query(4)
def merge_projects_keep_first(v: Views) -> DataFrame:
    obs, in_first = v.obs(), "(decile <= 5 AND NOT (title = '1-URGENT' AND scenario = 'BUILDING'))"
    first = sum_by(obs.filter(in_first), ["title", "scenario"], "value")
    second = sum_by(obs.filter(f"NOT {in_first}"), ["title", "scenario"], "value")
    return catalog.merge_projects(
        first.withColumn("project", F.lit("first")), second.withColumn("project", F.lit("second"))
    )


# Operators ---------------------------------------------------------------------------------------


@query(4)
def complete_years(v: Views) -> DataFrame:
    cells = v.obs().groupBy("scenario", "region", "title", "year").agg(F.sum("value").alias("demand"))
    cells = staged(cells, "cells")
    years = (*range(1994, 2000), 2005)
    return complete(cells, ["scenario", "region", "title"], years, {"demand": 0.0})


@query(4)
def strict_join(v: Views) -> DataFrame:
    keys = v.nations().select("region", "n_nationkey")
    joined = strict_left_join(v.obs().select("region", "year", "value"), keys, ["region"])
    return sum_by(joined, ["n_nationkey", "year"], "value")


@query(4)
def natural_left_join_strict_sum(v: Views) -> DataFrame:
    """A group with one ungrouped part type has an unknown total."""
    pairs = [(k, float(len(g))) for k, g in TYPE_GROUPS.items()]
    factors = literal_table(v.spark, pairs, "technology string, factor double")
    rows = natural_left_join(
        v.service().select("region", "year", "decile", "flag", "technology", "demand"), factors
    )
    rows = rows.withColumn("weighted", F.col("demand") * F.col("factor"))
    return sum_by(rows, ["region", "year", "decile", "flag"], "weighted")


@query(8)
def share_of_group(v: Views) -> DataFrame:
    cells = v.obs().groupBy("scenario", "region", "year").agg(F.sum("value").alias("value"))
    return share_of_total(staged(cells, "cells"), ["scenario", "year"], "value", "share").drop("value")


@query(8)
def weighted_ratios(v: Views) -> DataFrame:
    rows = v.service(part=False).select("scenario", "year", "cost", "demand", "discount")
    return weighted_ratio(
        rows, ["scenario", "year"], "discount", {"by_demand": "demand", "by_cost": "cost"}
    )


@query(9)
def calibrated(v: Views) -> DataFrame:
    observed = v.nations().select("region", (F.col("n_nationkey") + 100.0).alias("seen"))
    return calibrate(
        staged(v.gdp(), "gdp"), observed, ["scenario", "region"], ["region"], "value", "seen", 1998, "scaled", "factor"
    ).drop("value")


@query(4)
def region_fold(v: Views) -> DataFrame:
    return fold_member(v.obs(), "region", "NATION_1", "NATION_0", CELL, "value")


@query(4)
def member_duplicate(v: Views) -> DataFrame:
    return duplicate_member(
        v.pop(), F.col("region") == "NATION_0", super_region="COPY", region="NATION_X", value=1.0
    )


@query(4)
def wide_by_year(v: Views) -> DataFrame:
    cells = v.obs().groupBy(*CELL).agg(F.sum("value").alias("value"))
    return pivot_years(cells, ["scenario", "region"], YEARS)


@query(None)
def wide_to_long(v: Views) -> DataFrame:
    wide = pivot_years(v.gdp(), ["scenario", "region"], YEARS)
    wide = wide.withColumnsRenamed({str(y): f"X{y}" for y in YEARS})
    return complete_cases(unpivot_years(wide, ["scenario", "region"]))


@query(4)
def two_periods(v: Views) -> DataFrame:
    cells = v.obs().groupBy("scenario", "region", "title", "year").agg(F.sum("value").alias("value"))
    return two_period(cells, ["scenario", "region", "title"], 1995, 2001, ["value"])


@query(4)
def zero_filled_full_join(v: Views) -> DataFrame:
    """Sums per scenario, nation, year and decile, with those that have no order at zero."""
    keys = ["scenario", "region", "year", "decile"]
    sums = sum_by(v.obs().select(*keys, "value"), keys, "value")
    deciles = F.explode(F.array(*[F.lit(d) for d in DECILES])).alias("decile")
    every = v.spine().select("scenario", "region", "year", deciles)
    return zero_fill(sums.join(every, keys, "full"), ["year", "decile"])


@query(4)
def numeric_sums(v: Views) -> DataFrame:
    return sum_numeric_by(match_rows(v.lines(), "technology", "^S"), ["technology"])


@query(8)
def means(v: Views) -> DataFrame:
    return mean_by(v.service(part=False), ["scenario", "year"], "cost", "discount")


@query(None)
def scenario_parse(v: Views) -> DataFrame:
    """Names with several sectors in them, so that the order of the sector tests shows."""
    words = F.array(
        *[F.lit(w) for w in ("afolu", "ind", "bld", "trn", "dac", "sup", "all", "indbld", "afolusup", "dactrn")]
    )
    name = F.concat(
        F.lit("study_"), F.get(words, F.col("decile") - 1), F.col("decile").cast("string"), F.lit("_"),
        F.col("super_region"),
    )
    names = v.obs().select(name.alias("scenario")).distinct()
    gt, sector, ssp = C.scenario_parts("scenario")
    return names.select(
        "scenario",
        split_last("scenario")[0].alias("adj"),
        gt.cast("int").alias("gt"),
        sector.alias("sector"),
        F.lower(ssp).alias("ssp"),
    )


# Poverty and hunger ------------------------------------------------------------------------------


def _income(v: Views) -> DataFrame:
    return economy.income_by_decile(
        v.income(), BASELINE, REPORT_TO, corrections={"NATION_3": 20.0}
    )


@query(None)
def income_by_decile(v: Views) -> DataFrame:
    return _income(v)


def _multipliers(v: Views) -> DataFrame:
    return v.nations().select("region", (1 + F.col("n_nationkey") / 10).alias("energy_mult"))


def _energy(v: Views, household: DataFrame, pop: DataFrame, income: DataFrame) -> DataFrame:
    sector = F.col("consumer").alias("sector")
    price = household.select("scenario", "region", sector, "year", (F.col("cost") / 1e9).alias("value"))
    output = household.select("scenario", "region", sector, "year", F.col("demand").alias("value"))
    return economy.energy_share(price, output, pop, _multipliers(v), income, 2.0, YEARS)


def _food(v: Views, household: DataFrame, pop: DataFrame, income: DataFrame) -> DataFrame:
    def table(value: str, scale: float) -> DataFrame:
        inputs = F.explode(F.array(*[F.lit(g) for g in FOOD_TYPES]))
        rows = household.select(
            *CELL, "consumer", F.lit("FoodDemand").alias("nodeinput"), inputs.alias("input"),
            (F.col(value) * scale).alias("value"),
        )
        staple = F.col("input") == "FoodDemand_Staples"
        return rows.withColumn("value", F.when(staple, F.col("value") / 2).otherwise(F.col("value")))

    observed = v.nations().select("region", (F.col("n_nationkey") + 100.0).alias("av_food_exp"))
    return economy.food_share(
        table("cost", 1e-9), table("demand", 1.0), pop, observed, income, 0.5, YEARS, 1998
    )


@query(6)
def energy_share(v: Views) -> DataFrame:
    return _energy(v, v.household(), v.pop(), _income(v))


@query(6)
def bucketed_energy_share(v: Views) -> DataFrame:
    """The energy share over titles stored in buckets of region and year, joined where they lie."""
    root, household, unit = new_folder(v.spark, "bucketed"), v.household(), F.lit("-").alias("Units")
    cells = ["scenario", "region", F.col("consumer").alias("sector"), unit, "year"]
    titles = {
        "building service costs": household.select(*cells, (F.col("cost") / 1e9).alias("value")),
        "building service output by service": household.select(*cells, F.col("demand").alias("value")),
        "population by region": v.pop().select("scenario", "region", unit, "year", "value"),
        "subregional income": v.income().select("scenario", "region", "consumer", unit, "year", "value"),
    }
    run.create_project(root, titles, buckets=8)
    price, output, pop, income = (run.read_title(v.spark, root, t) for t in titles)
    income = economy.income_by_decile(income, BASELINE, REPORT_TO, corrections={"NATION_3": 20.0})
    with copartitioned(v.spark):
        return staged(economy.energy_share(price, output, pop, _multipliers(v), income, 2.0, YEARS), "energy_share")


@query(5)
def food_share_calibrated(v: Views) -> DataFrame:
    return _food(v, v.household(), v.pop(), _income(v)).drop("food_expenditure", "food_mult")


@query(6)
def basic_needs_world(v: Views) -> DataFrame:
    tables = v.household(), staged(v.pop(), "pop"), staged(_income(v), "income")
    return economy.basic_needs_world(_food(v, *tables), _energy(v, *tables), tables[1])


def _basket(v: Views, pop: DataFrame) -> DataFrame:
    consumption = v.service().select(
        "scenario", "region", "year", "technology",
        F.concat_ws(",", "technology", "flag").alias("subsector_1"),
        F.concat_ws(",", "flag", "status").alias("subsector_2"),
        (F.col("demand") / 1e9).alias("value"),
    )
    pairs = [(g, t) for g, types in FOOD_TYPES.items() for t in types]
    groups = literal_table(v.spark, pairs, "supplysector string, subsector string")
    inputs = F.explode(F.array(*[F.lit(g) for g in FOOD_TYPES]))
    price = v.income().select(*CELL, inputs.alias("input"), "value")
    return food.food_basket_regional(consumption, groups, pop, price)


@query(4)
def food_basket_regional(v: Views) -> DataFrame:
    return _basket(v, v.pop())


@query(4)
def food_basket_pct_gdp(v: Views) -> DataFrame:
    return food.food_basket_pct_gdp(_basket(v, v.pop()), v.gdp(), 1.25)


@query(4)
def food_basket_pct_gdp_world(v: Views) -> DataFrame:
    pop = staged(v.pop(), "pop")
    share = food.food_basket_pct_gdp(_basket(v, pop), v.gdp(), 1.25)
    return food.food_basket_pct_gdp_world(share, pop)


@query(3)
def food_basket_pct_gdp_published(v: Views) -> DataFrame:
    pop = staged(v.pop(), "pop")
    share = food.food_basket_pct_gdp(_basket(v, pop), v.gdp(), 1.25, faithful=True)
    return food.food_basket_pct_gdp_world(share, pop)


# Health ------------------------------------------------------------------------------------------


@query(10)
def paf_mortality(v: Views) -> DataFrame:
    obs = v.obs().select(*CELL, F.col("title").alias("disease"), F.col("decile").alias("age"), "value")
    cause = ["region", "year", "disease", "age"]
    rates = obs.groupBy(*cause).agg((F.avg("value") / 1_000_003).alias("rate"))
    risk = obs.groupBy("scenario", *cause).agg((1 + F.count(F.lit(1)) / 10).alias("rr"))
    exposed = obs.groupBy(*CELL, "age").agg(F.count(F.lit(1)).cast("double").alias("exposed"))
    return health.paf_mortality(rates, risk, exposed)


def _shares(v: Views) -> DataFrame:
    wide = pivot_years(staged(v.pop(), "pop"), ["scenario", "region"], YEARS).select(
        F.col("scenario").alias("SCENARIO"),
        F.col("region").alias("REGION"),
        F.lit("Population").alias("VARIABLE"),
        *[F.col(f"`{y}`").alias(f"X{y}") for y in YEARS],
    )
    # The merged macro-region has no countries of its own.
    merged = F.when(F.col("super_region") == "MIDDLE EAST", "EUROPE").otherwise(F.col("super_region"))
    countries = v.nations().select(F.col("region").alias("country"), merged.alias("macro_region"))
    return health.country_shares(wide, countries, BASELINE, ("NATION_0", "AFRICA"))


@query(8)
def country_share(v: Views) -> DataFrame:
    return _shares(v)


@query(2)
def mortality_downscaled(v: Views) -> DataFrame:
    rows = v.obs().select(
        "scenario", F.col("super_region").alias("region"), "year", F.col("title").alias("disease"),
        F.col("decile").alias("age"), (F.col("value") / 1000).alias("GBD"),
        (F.col("value") / 3000).alias("Jerret2009"),
    )
    regions = v.nations().select(
        F.col("region").alias("country"),
        F.concat(F.lit("M"), (F.col("n_nationkey") % 7).cast("string")).alias("model_region"),
    )
    extra = literal_table(v.spark, [("AFRICA", "M7")], "country string, model_region string")
    deaths = health.deaths_by_cause(rows, rows, merged=("MIDDLE EAST", "EUROPE"))
    return health.health(
        staged(deaths, "deaths"), _shares(v), regions.unionByName(extra), YEARS, REPORT_TO
    )


# Water -------------------------------------------------------------------------------------------


def _scarcity(v: Views) -> DataFrame:
    runoff, curves, wd_runoff, wd_ground = v.water_tables()
    return water.water_scarcity(
        water.water_supply(runoff, curves), water.water_withdrawal(wd_runoff, wd_ground), 1995
    )


@query(4)
def water_supply(v: Views) -> DataFrame:
    runoff, curves, _, _ = v.water_tables()
    return water.water_supply(runoff, curves)


@query(4)
def water_withdrawal(v: Views) -> DataFrame:
    _, _, runoff, ground = v.water_tables()
    return water.water_withdrawal(runoff, ground)


@query(8)
def water_scarcity_index(v: Views) -> DataFrame:
    return _scarcity(v)


@query(8)
def water_scarcity_runoff(v: Views) -> DataFrame:
    return water.water_scarcity_runoff(_scarcity(v))


# Land --------------------------------------------------------------------------------------------


@query(4)
def land_projection_wide(v: Views) -> DataFrame:
    kinds = {
        "SMALL": "Hardwood_Forest", "MEDIUM": "Softwood_Forest", "LARGE": "Pasture",
        "STANDARD": "Corn", "ECONOMY": "Wheat", "PROMO": "Urban",
    }
    kind = F.lit(None).cast("string")
    for p_type, name in kinds.items():
        kind = F.when(F.col("technology") == p_type, name).otherwise(kind)
    crop = F.col("technology").isin("STANDARD", "ECONOMY")
    suffix = F.when(crop & (F.col("flag") == "A"), "_IRR_hi").when(crop & (F.col("flag") == "N"), "_RFD")
    basin = (F.col("l_suppkey") % 6).cast("string")
    rows = v.service().select(
        "scenario", "region", "year", F.lit("thous km2").alias("Units"),
        F.concat(kind, F.lit("_G"), basin, F.coalesce(suffix, F.lit(""))).alias("landleaf"),
        F.col("demand").alias("value"),
    )
    # The sixth basin is not in the mapping, so its rows leave the projection.
    pairs = [(f"G{i}", i + 1) for i in range(5)]
    basins = literal_table(v.spark, pairs, "GLU_name string, basin_id int")
    return land.land_projection(rows, basins, YEARS[1:])


@query(4)
def grid_pivot_classes(v: Views) -> DataFrame:
    return land.grid_classes(v.grid(), tuple(LAND_CLASSES.values()))


@query(4)
def grid_pivot_all(v: Views) -> DataFrame:
    ids = ["scenario", "year", "lon", "lat"]
    return pivot_complete(v.grid(), ids, "landclass", "value", tuple(LAND_CLASSES.values()))


# Polygons as closed rings (id, corners); the third ring is a hole of the second polygon.
ECO_RINGS = (
    (1, ((-180, -90), (0, -90), (0, 0), (-180, 0))),
    (2, ((-15, 0), (170, 0), (170, 90), (-15, 90))),
    (2, ((20, 20), (70, 20), (70, 50), (20, 50))),
    (3, ((-170, 10), (-20, 10), (-95, 80))),
    (4, ((-45, -45), (45, -45), (0, 45))),
)
ECO_CODES = ((1, "E1"), (2, "E2"), (3, "E1"), (4, "E4"), (5, "E5"))
ECO_NAMES = (("E1", "first"), ("E2", "second"), ("E5", "no cells"), ("E9", "no polygon"))
ECO_FACTORS = (("E1", 1e-7, 2e-7, 3e-7, 4e-7), ("E2", 5e-7, 1e-7, 2e-7, 1e-7), ("E5", 1.0, 1.0, 1.0, 1.0))
POINT_RINGS = (
    (1, ((-0.3, -0.3), (0.2, -0.25), (0.0, 0.3))),
    (2, ((-0.1, -0.1), (0.35, -0.1), (0.35, 0.2), (-0.1, 0.2))),
    (3, ((0.05, 0.0), (0.3, 0.0), (0.3, 0.35), (0.05, 0.35))),
)


def edge_rows(rings) -> list[tuple]:
    return [
        (poly, float(a[0]), float(a[1]), float(b[0]), float(b[1]))
        for poly, corners in rings
        for a, b in zip(corners, corners[1:] + corners[:1])
    ]


def _edges(spark: SparkSession, rings) -> DataFrame:
    return literal_table(spark, edge_rows(rings), "poly_id int, x1 double, y1 double, x2 double, y2 double"
    )


@query(4)
def cell_map(v: Views) -> DataFrame:
    cells = v.grid().select("lon", "lat").distinct()
    return _cell_map(v, cells)


def _cell_map(v: Views, cells: DataFrame) -> DataFrame:
    hits = point_in_polygon(cells, _edges(v.spark, ECO_RINGS), 20.0, ("lon", "lat"), "lon", "lat")
    return hits.withColumnRenamed("poly_id", "OBJECTID")


def _areas(v: Views) -> DataFrame:
    grid = staged(v.grid(), "grid")
    cells = _cell_map(v, grid.select("lon", "lat").distinct())
    ecoregions = literal_table(v.spark, list(ECO_CODES), "OBJECTID int, eco_code string")
    names = literal_table(v.spark, list(ECO_NAMES), "ECOREGION_CODE string, ECO_NAME string")
    periods = land.grid_periods(grid, tuple(LAND_CLASSES.values()))
    return land.ecoregion_areas(periods, cells, ecoregions, names, SCENARIOS)


def _loss(v: Views) -> DataFrame:
    factors = literal_table(v.spark, list(ECO_FACTORS),
        "ECOREGION_CODE string, Forest_CF double, Pasture_CF double, Irrigated_crop_CF double, "
        "Rainfed_crop_CF double",
    )
    return land.species_loss(_areas(v), factors)


@query(0)
def ecoregion_areas(v: Views) -> DataFrame:
    return _areas(v)


@query(4)
def species_loss(v: Views) -> DataFrame:
    return _loss(v)


@query(None)
def points_in_polygons(v: Views) -> DataFrame:
    return point_in_polygon(v.points(), _edges(v.spark, POINT_RINGS), 0.05, ("vec_id",))


def detailed_ring(corners: int = 1200) -> tuple[tuple[float, float], ...]:
    """A star around the origin with one very detailed stretch: nearly all corners lie within a tenth of its turn."""
    turns = [i / 40 for i in range(40)] + [0.25 + 0.1 * i / corners for i in range(1, corners)]
    radius = {t: 0.28 + 0.05 * (-1) ** i for i, t in enumerate(sorted(turns))}
    return tuple((round(r * cos(2 * pi * t), 6), round(r * sin(2 * pi * t), 6)) for t, r in sorted(radius.items()))


DETAILED_RINGS = ((1, detailed_ring()), *POINT_RINGS[1:])


@query(None)
def points_in_detailed_polygons(v: Views) -> DataFrame:
    """One ring has most of its edges in few places: cells are split there, and a point meets few edges everywhere."""
    edges = v.spark.createDataFrame(edge_rows(DETAILED_RINGS), "poly_id int, x1 double, y1 double, x2 double, y2 double")
    return point_in_polygon(v.points(), edges, 0.25, ("vec_id",), crowd=24)


# Comparison and report ---------------------------------------------------------------------------


@query(8)
def compare_relative(v: Views) -> DataFrame:
    runs = v.run_tables()
    gdp = economy.gdp_per_capita_world(runs["gdp"], runs["pop"])
    return C.compare(gdp, "GDPpc_thous", "Thous$/pers", "Economy", relative=True, **WINDOW)


@query(8)
def compare_absolute(v: Views) -> DataFrame:
    runs = v.run_tables()
    return C.compare(
        water.water_scarcity_runoff(runs["water"]), "index_wd", "Index", "Water", **WINDOW
    )


@query(8)
def compare_water_scarcity(v: Views) -> DataFrame:
    """The comparison on top of the whole water pipeline, one family."""
    name = F.when(F.col("scenario") == BASELINE, "study_base_SSP2")
    for segment, label in (
        ("AUTOMOBILE", "trn10"), ("FURNITURE", "bld10"), ("HOUSEHOLD", "afolu20"), ("MACHINERY", "ind20"),
    ):
        name = name.when(F.col("scenario") == segment, f"study_{label}_SSP2")
    index = water.water_scarcity_runoff(_scarcity(v)).withColumn("scenario", name)
    return C.compare(
        staged(index, "index"), "index_wd", "Index", "Water", ssps=("SSP2",),
        sectors=("afolu", "bld", "ind", "trn"), **WINDOW,
    )


@query(8)
def compare_legacy(v: Views) -> DataFrame:
    runs = v.run_tables()
    gdp = economy.gdp_per_capita_world(runs["gdp"], runs["pop"])
    one = gdp.filter(F.col("scenario").contains("SSP2")).select(
        F.regexp_replace("scenario", r"^study_([a-z]+)(\d*)_SSP2$", "study_$1_$2").alias("scenario"),
        "year",
        "GDPpc_thous",
    )
    return C.compare_legacy(one, "GDPpc_thous", "study_base_", "Thous$/pers", "Economy", **WINDOW)


@query(8)
def legacy_report(v: Views) -> DataFrame:
    def one(df: DataFrame) -> DataFrame:
        name = F.regexp_replace("scenario", r"^study_([a-z]+)(\d*)_SSP2$", "study_$1_$2")
        return df.filter(F.col("scenario").endswith("SSP2")).withColumn("scenario", name)

    runs = {k: one(df) for k, df in v.run_tables().items() if k not in ("expenditure", "land")}
    unmanaged = runs["food"].select(
        "scenario", "year", (F.col("expenditure_percent_GDP") / 3).alias("percent_unmanaged")
    )
    return C.legacy_report("study_base_", land=unmanaged, **runs, **WINDOW)


@query(6)
def scalar_baseline(v: Views) -> DataFrame:
    return C.scalar_difference(v.run_tables()["land"], "value", "PSL", "PSL", "SSP3")


@query(8)
def deliverable_wide(v: Views) -> DataFrame:
    return C.deliverable(
        C.report_differences(**v.run_tables(), **WINDOW), sectors=("afolu", "bld", "ind", "trn")
    )


# Files -------------------------------------------------------------------------------------------


@query(6)
def gather_union(v: Views) -> DataFrame:
    """Indicator outputs written per project, then one family's projects read back by name."""
    runs = v.run_tables()["food"]
    project = project_name(F.concat(F.lit("database_basexdb_"), F.col("scenario"), F.lit(".dat")))
    root = new_folder(v.spark, "gather")
    files.write_indicator(runs.withColumn("project", project), root, "food")
    schema = StructType([f for f in runs.schema.fields])
    rows = files.read_indicator(v.spark, root, "food", schema, "SSP[24]$")
    return rows.filter(~F.col("project").rlike("base")).drop("project").distinct()


@query(4)
def scan_text_files(v: Views) -> DataFrame:
    """CSV parts of two tables in one folder, with other columns in another order, selected by name and bound by column name."""
    root = new_folder(v.spark, "scan")
    cells = v.obs().groupBy("scenario", "year").agg(F.sum("value").alias("value"))
    schema = StructType(cells.schema.fields)
    cells.filter("year < 1998").write.mode("append").csv(root, header=True)
    cells.filter("year >= 1998").select("value", "year", F.lit("-").alias("note"), "scenario").write.mode("append").csv(root, header=True)
    return files.scan_matching(v.spark, root, r"\.csv$", schema, "^_")


@query(4)
def gathered_tables(v: Views) -> DataFrame:
    """A gathered table written twice, as Parquet and CSV, and read back from both."""
    root = new_folder(v.spark, "gathered")
    food_table = v.run_tables()["food"]
    files.write_gathered(food_table, root, "food", "ALL")
    rows = files.extract_matching(v.spark, f"{root}/food", food_table.schema, r"\.(csv|parquet)$", "^_")
    return rows.groupBy("scenario", "year").agg(
        F.count(F.lit(1)).alias("copies"),
        F.max("expenditure_percent_GDP").alias("expenditure_percent_GDP"),
    )


@query(None)
def registered_title(v: Views) -> DataFrame:
    """A table registered in a project under its title and read back for some scenarios."""
    root = new_folder(v.spark, "project")
    table = v.gdp().select("scenario", "region", F.lit("thous$").alias("Units"), "year", "value")
    title = "GDP per capita PPP by region"
    catalog.register_title(root, title, table)
    return catalog.read_query(v.spark, root, title, ["BUILDING", "MACHINERY"])


@query(4)
def first_file_not_empty(v: Views) -> DataFrame:
    """The first matching file of a folder in which an empty one comes before and after."""
    root = new_folder(v.spark, "first")
    cells = v.obs().groupBy("scenario", "year").agg(F.sum("value").alias("value"))
    nothing = v.spark.range(0).select(F.col("id").cast("string"))
    for _ in range(3):
        nothing.coalesce(1).write.mode("append").text(root)
    cells.coalesce(1).write.mode("append").csv(root, header=True)
    return files.scan_first(v.spark, root, r"^part-.*\.(csv|txt)$", StructType(cells.schema.fields))


@query(4)
def preamble_lookup(v: Views) -> DataFrame:
    """A lookup with free text above its header and NA in some rows; these rows stay."""
    path = f"{new_folder(v.spark, 'preamble')}/lookup"
    mult = F.when(F.col("n_nationkey") % 5 == 0, "NA").otherwise((1 + F.col("n_nationkey") / 10).cast("string"))
    year = F.when(F.col("n_nationkey") % 7 == 0, "NA").otherwise("2005")
    lines = v.nations().select(F.concat_ws(",", "region", mult, year).alias("value"))
    head = [("Multipliers",), ("source: survey, 2005 edition",), ("region,energy_mult,year",)]
    literal_table(v.spark, head, "value string").unionByName(lines).write.text(path)
    return files.read_preamble_csv(v.spark, path, files.ENERGY_MULTIPLIER_SCHEMA, "energy_mult")


@query(None)
def lookup_csv(v: Views) -> DataFrame:
    path = f"{new_folder(v.spark, 'lookup')}/groups"
    v.nations().select("super_region", "region").write.csv(path, header=True, lineSep="\n")
    return files.read_lookup(v.spark, path, files.FOOD_GROUPS_SCHEMA)


@query(None)
def scenario_folders(v: Views) -> DataFrame:
    """A table written with one folder per scenario and read back."""
    path = f"{new_folder(v.spark, 'scenarios')}/gdp"
    table = v.gdp()
    files.write_by_scenario(table, path)
    return v.spark.read.csv(path, schema=table.schema, header=True, nullValue="NA")


@query(4)
def prefixes_stripped(v: Views) -> DataFrame:
    return strip_prefix(sum_by(v.obs(), ["scenario", "year"], "value").toDF("obs.scenario", "obs.t.year", "sum.value"))


@query(None)
def columns_by_predicate(v: Views) -> DataFrame:
    obs = v.obs()
    return obs.select(*cols_matching(obs, lambda c: c.endswith("region") or c == "scenario")).distinct()


@query(None)
def income_of_all_scenarios(v: Views) -> DataFrame:
    return economy.income_by_decile(v.income(), "", 2001, keep_scenario=True, corrections={})


@query(None)
def grid_to_rows(v: Views) -> DataFrame:
    """Arrays over years and scenarios become rows; null and NaN cells are dropped."""
    place = F.when(F.col("year") == 1999, F.lit(float("nan"))).when(F.col("year") != 2000, F.col("value"))
    cell = F.struct(F.array_position(F.array(*[F.lit(s) for s in SCENARIOS]), F.col("scenario")).alias("at"), "year", place.alias("v"))
    grids = v.gdp().groupBy("region").agg(F.array_sort(F.collect_list(cell)).alias("cells"))
    lon = F.array(*[F.lit(y) for y in YEARS]).alias("lon")
    lat = F.array(*[F.lit(i) for i in range(1, len(SCENARIOS) + 1)]).alias("lat")
    return catalog.grid_long(grids.select("region", lon, lat, F.transform("cells", lambda c: c["v"]).alias("value")))


LON, LAT = Axis(-180.0, 0.5), Axis(listed=[89.5 - 3 * i for i in range(53)])


def _tiles(v: Views) -> DataFrame:
    """Order lines on a grid of 97 x 53 cells, stored as tiles of uneven sizes."""
    col, row = (F.col("l_partkey") % 97).cast("int"), (F.col("l_suppkey") % 53).cast("int")
    cells = v.service(part=False).groupBy("scenario", col.alias("col"), row.alias("row")).agg(F.sum("demand").alias("value"))
    path = f"{new_folder(v.spark, 'grid')}/demand"
    grids.cut_into_tiles(cells, ["scenario"], 20, 9, n_cols=97).write.parquet(path)
    return v.spark.read.parquet(path)


@query(4)
def grid_tiles(v: Views) -> DataFrame:
    return grids.tile_rows(_tiles(v), LON, LAT)


@query(4)
def grid_tiles_within(v: Views) -> DataFrame:
    """The cells of a window; tiles outside are not read."""
    return grids.tile_rows(_tiles(v), LON, LAT, bounds=(-171.0, 50.0, -150.0, 80.0))


@query(None)
def split_nests(v: Views) -> DataFrame:
    """The first part of a comma-separated path, per order line's part."""
    path = F.concat_ws(",", "technology", "flag", "status")
    return v.service().select("technology", "flag", split_first(path).alias("nest")).distinct()


@query(None)
def project_names(v: Views) -> DataFrame:
    names = v.nations().select("region", F.when(F.col("n_nationkey") % 2 == 0, "base").otherwise("ssp2").alias("ssp"))
    return names.select("region", project_db_name("region", "ssp").alias("project"))


def _predicate_rows(v: Views) -> DataFrame:
    """Rows that the filters of the catalog keep or not, one column for each that they read."""

    def pick(*members: str) -> Column:
        choices = F.array(*[F.lit(m) for m in members])
        return F.element_at(choices, (F.col("decile") % len(members) + 1).cast("int"))

    return v.obs().select(
        "scenario",
        "decile",
        F.col("year"),
        pick("FoodDemand_Staples", "FoodDemand_NonStaples", "building", "beef").alias("sector"),
        pick("FoodDemand", "FoodDemand_Group1", "FoodDemand_Group5", "x").alias("consumer"),
        pick("gdp-per-capita-ppp", "GDP", "labor").alias("account"),
        pick("AgSupplySector", "energy").alias("sector_type"),
        pick("International Aviation", "International Ship", "rail").alias("subsector"),
        pick("CO2", "CO2_FUG", "CH4", "N2O", "none").alias("GHG"),
        pick("a_water withdrawals", "land").alias("resource"),
        pick("runoff", "groundwater", "runoff groundwater").alias("subresource"),
        pick("building", "industry", "transport").alias("final_energy"),
    )


@query(None)
def catalog_predicates(v: Views) -> DataFrame:
    """Rows per scenario that each title's filter keeps, for all titles."""
    rows = staged(_predicate_rows(v), "predicates")
    kept = [
        catalog.where_catalog(rows, t).groupBy("scenario").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("title", F.lit(t))
        for t in catalog.CATALOG
    ]
    return union_by_name(*kept)


def _store_runs(v: Views, absent: tuple[str, ...] = ()) -> str:
    """All indicator tables of the runs, stored as a project's outputs, one project per run."""
    root = new_folder(v.spark, "runs")
    names = {"pop": "population"}
    for name, df in v.run_tables().items():
        if name in absent:
            continue
        target = names.get(name, name)
        fields = StructType.fromDDL(run.STORED[target]).fields
        cols = [F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
        files.write_indicator(df.select(*cols, F.col("scenario").alias("project")), root, target)
    return root


@query(6)
def committed_runs(v: Views) -> DataFrame:
    """Two runs of each family's outputs, the second one with other values: readers see the second one whole."""
    root, cells = new_folder(v.spark, "committed"), v.run_tables()
    for factor in (1, 2):
        for ssp in ("SSP2", "SSP4"):
            food = cells["food"].filter(F.col("scenario").endswith(ssp))
            more = food.withColumn("expenditure_percent_GDP", F.col("expenditure_percent_GDP") * factor)
            gdp = cells["gdp"].filter(F.col("scenario").endswith(ssp))
            versions.commit(v.spark, root, f"study {ssp}", {"food": run.shaped("food", more), "gdp": run.shaped("gdp", gdp)})
    versions.vacuum(v.spark, root)
    return run.stored(v.spark, root, "food")


@query(6)
def gather_family(v: Views) -> DataFrame:
    return run.gather_family(v.spark, _store_runs(v, ("gdp", "pop", "expenditure", "health", "water", "land")), "food", "SSP3")


@query(6)
def gather_reference(v: Views) -> DataFrame:
    return run.gather_reference(v.spark, _store_runs(v, ("gdp", "pop", "expenditure", "health", "water", "land")), "food")


@query(6)
def gather_psl(v: Views) -> DataFrame:
    """Species loss per class, written as CSV and as Parquet, and gathered from both."""
    root, table = new_folder(v.spark, "psl"), _loss(v)
    shaped = table.select(*StructType.fromDDL(gather.PSL_COLUMNS).names)
    stored_rows = staged(shaped, "psl_rows")
    stored_rows.coalesce(1).write.mode("append").csv(root, header=True)
    stored_rows.coalesce(1).write.mode("append").parquet(root)
    rows = gather.gather_psl(v.spark, root)
    return rows.groupBy("scenario").agg(F.count(F.lit(1)).alias("copies"), F.max("final_PSL").alias("final_PSL"))


@query(8)
def report_end_to_end(v: Views) -> DataFrame:
    """Indicator tables stored per project, read back and built into the report."""
    return run.build_report(v.spark, _store_runs(v), sectors=("afolu", "bld", "ind", "trn"), **WINDOW)


@query(8)
def report_without_health_and_land(v: Views) -> DataFrame:
    root = _store_runs(v, ("health", "land"))
    return run.build_report(v.spark, root, sectors=("afolu", "bld", "ind", "trn"), **WINDOW)


@query(None)
def report_order(v: Views) -> DataFrame:
    """The place of each row in the report, which is sorted by indicator and numeric level."""
    report = C.deliverable(C.report_differences(**v.run_tables(), **WINDOW), sectors=("afolu", "bld", "ind", "trn"))
    return placed(report.select("sdg", "Gt_CO2_reduction"), report_rows_order("sdg", "Gt_CO2_reduction"))


@query(None)
def level_order(v: Views) -> DataFrame:
    """The place of each order's key, as text, in numeric order."""
    keys = v.obs().select(F.concat(F.col("o_orderkey"), F.lit(".50")).alias("Gt_CO2_reduction"))
    return placed(keys, numeric_order("Gt_CO2_reduction"))


def _technology_cells(v: Views) -> DataFrame:
    rows = v.service().groupBy("scenario", "year", "technology", "flag").agg(F.count(F.lit(1)).alias("n"))
    return staged(rows, "technology_cells")


@query(None)
def open_pivot(v: Views) -> DataFrame:
    """Lines per technology and flag, as a map whose members no list names."""
    pivoted = pivot_open(_technology_cells(v), ["scenario", "year"], ["technology", "flag"], "n")
    shown = F.transform(F.map_entries("cells"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return pivoted.select("scenario", "year", F.array_join(shown, ",").alias("cells"))


@query(None)
def open_pivot_filled(v: Views) -> DataFrame:
    """Regions in which an order priority has orders over a value: every row has all members, and some become columns."""
    rows = v.obs().filter("value > 400000").groupBy("scenario", "region", "title").agg(F.count(F.lit(1)).alias("n"))
    pivoted = pivot_open(staged(rows, "large_orders"), ["scenario", "region"], "title", "n", fill=0)
    wide = widened(pivoted, ["1-URGENT", "5-LOW", "no such"], other="keep")
    return wide.select("scenario", "region", "1-URGENT", "5-LOW", F.col("no such"), F.size("cells").alias("others"))


def _revenue(v: Views) -> DataFrame:
    rows = v.service(part=False)
    return rows.select("scenario", "region", "year", (F.col("cost") * F.col("demand") * (1 - F.col("discount"))).alias("revenue"), "discount")


@query(None)
def exact_revenue(v: Views) -> DataFrame:
    """Sums of doubles without rounding: every bit is that of the exact sum."""
    return exact_sums(_revenue(v), ["scenario", "year"], "revenue", "discount", counts=True)


@query(None)
def exact_mean_revenue(v: Views) -> DataFrame:
    return exact_means(_revenue(v), ["region"], "revenue")


@query(None)
def customer_ranks(v: Views) -> DataFrame:
    """Customers by their orders, most first: competition and dense ranks, and how many orders stand before."""
    counts = v.obs().groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    order = [F.col("n_orders").desc()]
    rows = ranked(counts, order, ["n_orders"], "rank")
    rows = ranked(rows, order, ["n_orders"], "dense_rank", dense=True)
    return placed(rows, [*order, "o_custkey"], "place", {"orders_before": "n_orders"})


@query(6)
def water_units_differ(v: Views) -> DataFrame:
    """Supply and withdrawal that spell the unit differently in some years: those years have no index."""
    return water.water_scarcity(*_units_differ(v), 1995)


def _units_differ(v: Views) -> tuple[DataFrame, DataFrame]:
    cells = staged(v.obs().groupBy("scenario", "region", "year").agg(F.sum("value").alias("value")), "water_cells")
    def side(units: Column, value: Column, name: str) -> DataFrame:
        return cells.select(
            "scenario", F.col("region").alias("basin"), F.lit("runoff").alias("subresource"), "year",
            units.alias("Units"), value.alias(name),
        )

    other = F.when((F.col("year") == 1995) | (F.col("year") % 2 == 0), "km^3").otherwise("km3")
    return side(F.lit("km3"), F.col("value"), "value_sup"), side(other, F.col("value") / 2 + 1, "value_wd")
