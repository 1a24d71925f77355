"""Projects to report: tables registered, indicators stored, all families compared."""

import itertools

import pytest
from pyspark.sql import functions as F

from scenlens.plans import run as R
from scenlens.sources.catalog import CATALOG, read_query
from scenlens.sources.shared import literal_table

YEARS = (2015, 2020, 2030)
REGIONS = ("A", "B")
PROJECTS = {
    "database_basexdb_sdgstudy_base.dat": ("base", ("base_SSP1", "base_SSP2")),
    "database_basexdb_SSP1_x.dat": ("SSP1", ("x_trn10_SSP1", "x_bld20_SSP1")),
    "database_basexdb_SSP2_x.dat": ("SSP2", ("x_trn10_SSP2",)),
}
MEMBERS = ("forest", "pasture", "corn_irrigated", "corn_rainfed")


def tables(spark, scenarios):
    """Every title's table; a scenario's position shifts its values."""
    cells = list(itertools.product(enumerate(scenarios), REGIONS, YEARS))

    def frame(title, rows):
        return spark.createDataFrame(rows, CATALOG[title].schema)

    def plain(title, unit, value):
        return frame(title, [(s, r, unit, y, value(i)) for (i, s), r, y in cells])

    def by_sector(title, sectors, value):
        return frame(title, [(s, r, x, "u", y, value(i)) for (i, s), r, y in cells for x in sectors])

    def by_income(title, value):
        keys = list(itertools.product(("FoodDemand_Group1", "FoodDemand_Group2"), ("FoodDemand_Staples", "FoodDemand_NonStaples")))
        return frame(title, [(s, r, c, "n", x, "u", y, value(i)) for (i, s), r, y in cells for c, x in keys])

    def basin(title, sub, value):
        return frame(title, [(s, r, f"basin{r}", sub, "km^3", y, value(i)) for (i, s), r, y in cells])

    eaten = [
        (s, r, "FoodDemand_Staples", "a,b", "c", item, "Pcal", y, 1.0 + i)
        for (i, s), r, y in cells
        for item in ("Rice", "Beef")
    ]
    services = ("resid heat_d1", "resid heat_d2")
    curves = [(s, r, f"basin{r}", "groundwater", "g1", "km^3", y, 5.0) for (_, s), r, y in cells]
    return {
        "population by region": plain("population by region", "thous", lambda i: 10.0),
        "GDP per capita PPP by region": plain("GDP per capita PPP by region", "thous$", lambda i: 5.0 + i),
        "subregional income": by_sector("subregional income", ("resid_d1", "resid_d2"), lambda i: 3.0),
        "building service costs": by_sector("building service costs", services, lambda i: 1e-9 * (1 + i)),
        "building service output by service": by_sector("building service output by service", services, lambda i: 100.0),
        "food demand prices by income group": by_income("food demand prices by income group", lambda i: 1.0 + i),
        "food demand by income group": by_income("food demand by income group", lambda i: 2.0),
        "food consumption by type (specific)": frame("food consumption by type (specific)", eaten),
        "Basin level available runoff": basin("Basin level available runoff", "runoff", lambda i: 10.0),
        "Water Withdrawals by Basin (Runoff)": basin("Water Withdrawals by Basin (Runoff)", "runoff", lambda i: 4.0 + i),
        "Water Withdrawals by Basin (Groundwater)": basin("Water Withdrawals by Basin (Groundwater)", "groundwater", lambda i: 1.0),
        "resource supply curves": frame("resource supply curves", curves),
    }


def lookups(spark, scenarios):
    deaths = [(s, "EU", y, 100.0 + 10 * i, 10.0) for i, s in enumerate(scenarios) for y in YEARS]
    wide = [("SSP2_x", c, "Population", *(1.0 for _ in YEARS)) for c in ("FRA", "DEU")]
    grid = [
        (s, y, 0.5, 0.5, m, 1.0 + i * (y == 2050))
        for i, s in enumerate(scenarios)
        for y in (2020, 2050)
        for m in MEMBERS
    ]
    pm = spark.createDataFrame(deaths, "scenario string, region string, year int, GBD double, Jerret2009 double")
    return R.Lookups(
        price_index={1975: 1.0, 1990: 2.0, 2005: 4.0},
        multiplier=literal_table(spark, [(r, 1.5) for r in REGIONS], "region string, energy_mult double"),
        observed_food=literal_table(spark, [(r, 100.0) for r in REGIONS], "region string, av_food_exp double"),
        pm25=pm,
        o3=pm,
        wide_pop=spark.createDataFrame(
            wide, "SCENARIO string, REGION string, VARIABLE string, " + ", ".join(f"X{y} double" for y in YEARS)
        ),
        macro_regions=literal_table(spark, [("FRA", "EU"), ("DEU", "EU")], "country string, macro_region string"),
        model_regions=literal_table(spark, [("FRA", "M"), ("DEU", "M")], "country string, model_region string"),
        health_years=YEARS,
        grid=spark.createDataFrame(grid, "scenario string, year int, lon double, lat double, landclass string, value double"),
        grid_members=MEMBERS,
        cell_map=literal_table(spark, [(0.5, 0.5, 1)], "lon double, lat double, OBJECTID int"),
        ecoregions=literal_table(spark, [(1, "E")], "OBJECTID int, eco_code string"),
        ecoregion_names=literal_table(spark, [("E", "Eee")], "ECOREGION_CODE string, ECO_NAME string"),
        factors=literal_table(
            spark, [("E", 1e-6, 1e-6, 1e-6, 1e-6)],
            "ECOREGION_CODE string, Forest_CF double, Pasture_CF double, Irrigated_crop_CF double, Rainfed_crop_CF double",
        ),
    )


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("projects")
    base = f"{root}/database_basexdb_sdgstudy_base.dat"
    for name, (_, scenarios) in PROJECTS.items():
        R.create_project(f"{root}/{name}", tables(spark, scenarios))
    for name, (ssp, scenarios) in PROJECTS.items():
        R.run_indicators(
            spark, f"{root}/{name}", base, f"{root}/out", name, ssp, lookups(spark, scenarios),
            scenarios=scenarios, details=True,
        )
    return f"{root}/out"


def test_every_project_is_stored(spark, stored):
    for name in R.STORED:
        assert R.stored(spark, stored, name).select("scenario").distinct().count() == 5
    total = R.stored(spark, stored, "total_share")
    assert total.filter("abs(food_expenditure_per + energy_expenditure_per - total_expenditure_per) > 1e-9").count() == 0
    assert total.count() == 5 * len(REGIONS) * len(YEARS) * 2
    one = R.stored(spark, stored, "water", "^SSP2")
    assert {r.scenario for r in one.collect()} == {"x_trn10_SSP2"}
    assert R.project_label("database_basexdb_SSP1_x.dat") == "SSP1_x"


def test_indicator_values(spark, stored):
    water = {
        (r.scenario, r.resource): r.index_wd
        for r in R.stored(spark, stored, "water").filter("year = 2030").collect()
    }
    assert water["x_trn10_SSP1", "runoff"] == pytest.approx(0.4)
    assert water["x_bld20_SSP1", "runoff"] == pytest.approx(0.5)
    assert water["x_bld20_SSP1", "groundwater"] == pytest.approx(0.2)
    deaths = {r.scenario: r.mort for r in R.stored(spark, stored, "health").filter("year = 2030").collect()}
    assert deaths["x_bld20_SSP1"] == 55 * 2 + 5 * 2
    land = {r.scenario: r.value for r in R.stored(spark, stored, "land").collect()}
    assert land["x_trn10_SSP1"] == 0.0 and land["x_bld20_SSP1"] == pytest.approx(4.0)


def test_report(spark, stored):
    report = R.build_report(spark, stored, ("SSP1", "SSP2"))
    rows = report.collect()
    # Only the level that both families have is reported, once per indicator.
    assert [(r.sdg, r.Gt_CO2_reduction) for r in rows] == [
        (s, 10.0) for s in ("Economy", "Health", "Hunger", "PSL", "Poverty", "Water")
    ]
    by_name = {r.sdg: r for r in rows}
    # The second baseline scenario is one step above the first in every shifted table.
    assert by_name["Water"].trn_ssp1 == pytest.approx(0.0)
    assert by_name["Water"].trn_ssp2 == pytest.approx(-0.1)
    assert by_name["Economy"].trn_ssp2 == pytest.approx(5 / 6 - 1)
    assert by_name["Health"].trn_ssp2 == -10.0
    assert by_name["PSL"].trn_ssp2 == pytest.approx(-4.0)
    assert by_name["Water"].sup_ssp1 is None


def test_raw_rows_are_filtered_by_title(spark, tmp_path):
    title = "GDP MER by region"
    raw = spark.createDataFrame(
        [("s", "A", "u", 2020, 1.0, "GDP"), ("s", "A", "u", 2020, 2.0, "other")],
        "scenario string, region string, Units string, year int, value double, account string",
    )
    R.create_project(str(tmp_path), {title: raw}, raw=True)
    assert [r.value for r in read_query(spark, str(tmp_path), title).collect()] == [1.0]
    title = "nonCO2 emissions by resource production"
    raw = spark.createDataFrame(
        [("s", "A", "coal", g, "u", 2020, 1.0) for g in ("CH4", "bldCO2", "CO2")], CATALOG[title].schema
    )
    R.create_project(str(tmp_path), {title: raw}, raw=True)
    assert sorted(r.GHG for r in read_query(spark, str(tmp_path), title).collect()) == ["CH4", "CO2"]


def test_default_food_groups(spark):
    groups = R.food_groups(spark)
    assert groups.count() == 21 and groups.filter(F.col("supplysector") == "FoodDemand_Staples").count() == 5


def test_scopes_delete_what_was_staged_inside(spark):
    from scenlens.sources import shared

    rows = spark.range(5)
    outside = shared.staged(rows, "outside")
    with shared.scope("test"):
        inside, read = shared.staged(rows, "inside"), shared.staged(rows, "read")
    later = read.filter("id > 2").union(outside)
    assert len(shared.roots_of(later)) == 2
    assert shared.delete_scope(spark, "test", but_for=[later]) == 1
    assert later.count() == 7 and outside.count() == 5
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
        inside.count()
    assert shared.delete_scope(spark, "test") == 1 and shared.delete_scope(spark, "test") == 0
