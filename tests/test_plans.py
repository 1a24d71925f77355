"""Indicators on tiny tables with values worked out by hand."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from scenlens.plans import compare as C
from scenlens.plans import economy as E
from scenlens.plans import food as FO
from scenlens.plans import health as H
from scenlens.plans import land as L
from scenlens.plans import water as W

LONG = "scenario string, region string, year int, value double"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def near(got, want):
    assert len(got) == len(want), (got, want)
    for g, w in zip(got, want):
        assert g == pytest.approx(w) if not isinstance(g, tuple) else all(
            a == pytest.approx(b) if isinstance(a, float) else a == b for a, b in zip(g, w)
        ), (g, w)


@pytest.fixture(scope="module")
def pop(spark):
    return spark.createDataFrame([("s", "A", 2020, 10.0), ("s", "B", 2020, 30.0)], LONG)


def test_population_weights(pop):
    near(rows(E.population_weights(pop)), [("s", "A", 2020, 0.25), ("s", "B", 2020, 0.75)])


def test_gdp_per_capita_world(spark, pop):
    gdp = spark.createDataFrame([("s", "A", 2020, 4.0), ("s", "B", 2020, 8.0)], LONG)
    near(rows(E.gdp_per_capita_world(gdp, pop)), [("s", 2020, 7.0)])
    with pytest.raises(PySparkException, match="no match"):
        E.gdp_per_capita_world(gdp, pop.filter("region = 'A'")).collect()


@pytest.fixture(scope="module")
def income(spark):
    raw = spark.createDataFrame(
        [
            ("base_SSP1", "A", "resid_d1", 2020, 1.0), ("base_SSP1", "B", "resid_d1", 2020, 2.0),
            ("base_SSP1", "South America_Northern", "resid_d1", 2020, 20.0),
            ("base_SSP1", "A", "trn_d1", 2020, 9.0), ("base_SSP1", "A", "resid_d1", 2060, 9.0),
            ("base_SSP2", "A", "resid_d1", 2020, 9.0),
        ],
        "scenario string, region string, consumer string, year int, value double",
    )
    return E.income_by_decile(raw, "SSP1")


def test_income_by_decile(income):
    assert rows(income) == [
        ("A", 1.0, 2020, 1000.0), ("B", 1.0, 2020, 2000.0), ("South America_Northern", 1.0, 2020, 1000.0),
    ]


@pytest.fixture(scope="module")
def energy(spark, pop, income):
    schema = "scenario string, region string, sector string, year int, value double"
    price = spark.createDataFrame(
        [
            ("s", "A", "resid heat_d1", 2020, 1e-9), ("s", "A", "resid cool_d1", 2020, 2e-9),
            ("s", "B", "resid heat_d1", 2020, 1e-9), ("s", "B", "comm heat", 2020, 5e-9),
            ("s", "A", "resid heat_d1", 2021, 1e-9),
        ],
        schema,
    )
    output = spark.createDataFrame(
        [("s", "A", "resid heat_d1", 2020, 1000.0), ("s", "B", "resid heat_d1", 2020, None)], schema
    )
    mult = spark.createDataFrame([("A", 1.5), ("B", 2.0)], "region string, energy_mult double")
    return E.energy_share(price, output, pop, mult, income, 2.0)


def test_energy_share(energy):
    # 1000 x 1 x 2 / (10 x 100 persons) x 1.5 = 3 per person; of 1000 = 0.3 %. No output counts as zero.
    near(rows(energy), [("s", "A", 1.0, 2020, 0.3), ("s", "B", 1.0, 2020, 0.0)])


@pytest.fixture(scope="module")
def food(spark, pop, income):
    schema = "scenario string, region string, consumer string, nodeinput string, input string, year int, value double"
    keys = [("s", r, "FoodDemand_Group1", "n", i, 2020) for r in "AB" for i in ("st", "non")]
    price = spark.createDataFrame([(*k, 1.0) for k in keys], schema)
    demand = spark.createDataFrame([(*k, 2.0) for k in keys], schema)
    seen = spark.createDataFrame([("A", 50.0), ("B", 300.0)], "region string, av_food_exp double")
    args = pop, seen, income, 1.0
    with pytest.raises(PySparkException, match="no match"):
        E.food_share(price, demand.filter("region = 'A'"), *args).collect()
    return E.food_share(price, demand, *args)


def test_food_share_is_calibrated_to_observed_spending(food):
    got = food.select("region", "food_expenditure_mult", "food_expenditure_per")
    near(rows(got), [("A", 50.0, 5.0 * 0.5575288), ("B", 300.0, 15.0 * 0.5575288)])


def test_basic_needs_world(food, energy, pop):
    a, b = 5 * 0.5575288 + 0.3, 15 * 0.5575288
    near(rows(E.basic_needs_world(food, energy, pop)), [("s", 2020, 0.1 * (a * 0.25 + b * 0.75))])


def test_income_of_the_baseline_itself_keeps_its_scenario(spark):
    raw = spark.createDataFrame(
        [("base_SSP1", "A", "resid_d1", 2020, 1.0)],
        "scenario string, region string, consumer string, year int, value double",
    )
    assert E.income_by_decile(raw, "base", keep_scenario=True).columns[0] == "scenario"


@pytest.fixture(scope="module")
def basket_inputs(spark):
    consumption = spark.createDataFrame(
        [
            ("s", "A", "st,x", "y", "Rice", 2020, 365.0e-9), ("s", "A", "st,x", "y", "Rice", 2020, 365.0e-9),
            ("s", "A", "n", "y", "Beef", 2020, 365.0e-9), ("s", "B", "n", "y", "Mystery", 2020, 1.0),
        ],
        "scenario string, region string, subsector_1 string, subsector_2 string, technology string, year int, value double",
    )
    groups = spark.createDataFrame([("st", "Rice"), ("n", "Beef")], "supplysector string, subsector string")
    price = spark.createDataFrame(
        [("s", r, i, 2020, v) for r in "AB" for i, v in (("st", 100.0), ("st", 200.0), ("n", 1000.0))],
        "scenario string, region string, input string, year int, value double",
    )
    return consumption, groups, price


def test_food_basket(spark, pop, basket_inputs):
    consumption, groups, price = basket_inputs
    bill = FO.food_basket_regional(consumption, groups, pop, price)
    # Rice: 2 x 365e-9 Pcal = 2e3 kcal/365 ... per 10000 persons and day: 0.2; x 0.3. Beef: 0.1 x 1.
    near(rows(bill), [("A", "s", 2020, 0.2 * 0.3 + 0.1 * 1.0), ("B", "s", 2020, None)])
    median = FO.food_basket_regional(consumption, groups, pop, price, consumer="median")
    near(rows(median.filter("region = 'A'").select("expenditure")), [(0.2 * 0.15 + 0.1 * 1.0,)])
    gdp = spark.createDataFrame([("s", "A", 2020, 3.65), ("s", "B", 2020, 1.0)], LONG)
    share = FO.food_basket_pct_gdp(bill, gdp, 2.0)
    near(rows(share.select("region", "expenditure_percent_GDP")), [("A", 0.8), ("B", None)])
    published = FO.food_basket_pct_gdp(bill, gdp, 2.0, faithful=True).filter("region = 'A'")
    assert published.first().expenditure_percent_GDP == pytest.approx(8.0)
    world = FO.food_basket_pct_gdp_world(share.filter("region = 'A'"), pop)
    assert world.first().expenditure_percent_GDP == pytest.approx(0.2)
    assert FO.food_basket_pct_gdp_world(share, pop).first().expenditure_percent_GDP is None


def test_paf_mortality(spark):
    rates = spark.createDataFrame([("A", 2020, "IHD", 1, 0.5)], "region string, year int, disease string, age int, rate double")
    risk = spark.createDataFrame([("s", "A", 2020, "IHD", 1, 1.25)], "scenario string, region string, year int, disease string, age int, rr double")
    pop = spark.createDataFrame([("s", "A", 2020, 1, 100.0)], "scenario string, region string, year int, age int, exposed double")
    near(rows(H.paf_mortality(rates, risk, pop).select("mort")), [(10.0,)])


@pytest.fixture(scope="module")
def shares(spark):
    wide = spark.createDataFrame(
        [
            ("SSP2_x", "FRA", "Population", 1.0, 1.0), ("SSP2_x", "DEU", "Population", 3.0, None),
            ("SSP2_x", "RUX", "Population", 5.0, 5.0), ("SSP2_x", "CHN", "Population", 7.0, 7.0),
            ("SSP1_x", "FRA", "Population", 9.0, 9.0), ("SSP2_x", "FRA", "GDP", 9.0, 9.0),
        ],
        "SCENARIO string, REGION string, VARIABLE string, X2020 double, X2030 double",
    )
    countries = spark.createDataFrame(
        [("FRA", "EU"), ("DEU", "EU"), ("RUX", "RUS"), ("CHN", "CHN")], "country string, macro_region string"
    )
    return H.country_shares(wide, countries)


def test_country_shares(shares):
    near(
        rows(shares),
        [
            ("CHN", "CHN", 2020, 1.0), ("CHN", "CHN", 2030, 1.0), ("EU", "DEU", 2020, 0.75),
            ("EU", "FRA", 2020, 0.25), ("EU", "FRA", 2030, 1.0), ("RUS", "RUX", 2020, 1.0),
            ("RUS", "RUX", 2030, 1.0), ("TWN", "TWN", 2020, 1.0), ("TWN", "TWN", 2030, 1.0),
        ],
    )


def test_mortality_downscaled(spark, shares):
    schema = "scenario string, region string, year string, GBD double, Jerret2009 double"
    raw = [("EU", 10.0, 2.0), ("RUS", 1.0, 0.0), ("RUE", 2.0, 0.0), ("CHN", 4.0, 0.0), ("TWN", 5.0, 1.0)]
    pm = spark.createDataFrame([(s, r, "2020", g, j) for s in "st" for r, g, j in raw], schema)
    regions = spark.createDataFrame(
        [("FRA", "Europe"), ("DEU", "Europe"), ("RUX", "Russia"), ("CHN", "China"), ("TWN", "Taiwan")],
        "country string, model_region string",
    )
    deaths = H.deaths_by_cause(pm, pm)
    got = rows(H.health(deaths, shares, regions, [2020]).filter("scenario = 's'").drop("scenario"))
    # PM2.5 in Europe: 10 x 0.75 = 7.5 and 2.5 round half-even to 8 and 2. O3: 1.5 -> 2 and 0.5 -> 0.
    near(got, [("China", 2020, 4.0), ("Europe", 2020, 12.0), ("Russia", 2020, 3.0), ("Taiwan", 2020, 6.0)])
    partial = H.deaths_by_cause(pm.filter("NOT (scenario = 't' AND region = 'EU')"), pm)
    with pytest.raises(Exception, match="a scenario has no deaths for"):
        H.health(partial, shares, regions, [2020]).collect()
    with pytest.raises(PySparkException, match="no match"):
        H.health(deaths, shares, regions, [2020, 2030]).collect()


@pytest.fixture(scope="module")
def water_tables(spark):
    def table(col, data):
        return spark.createDataFrame(
            [(s, b, sub, "km^3", y, v) for s, b, sub, y, v in data],
            f"scenario string, `{col}` string, subresource string, Units string, year int, value double",
        )

    runoff = table("basin", [("s", b, "runoff", y, v) for b, y, v in (("N", 2015, 10.0), ("N", 2020, 10.0), ("M", 2015, 30.0), ("M", 2020, 30.0), ("M", 2060, 1.0), ("Q", 2020, 1.0), ("Z", 2015, 0.0))])
    curves = table("resource", [("s", "N", "groundwater 1", 2015, 1.0), ("s", "N", "groundwater 2", 2015, 3.0), ("s", "N", "oil", 2015, 99.0)])
    wd = table("runoff water", [("s", b, "runoff", y, v) for b, y, v in (("N", 2015, 5.0), ("N", 2020, 8.0), ("M", 2015, 15.0), ("M", 2020, 3.0), ("Q", 2020, 1.0))])
    ground = table("groundwater", [("s", "N", "groundwater", 2015, 1.0), ("s", "N", "groundwater", 2015, 1.0)])
    return runoff, curves, wd, ground


def test_water_scarcity(water_tables):
    runoff, curves, wd, ground = water_tables
    supply, withdrawal = W.water_supply(runoff, curves), W.water_withdrawal(wd, ground)
    assert rows(supply.filter("subresource = 'groundwater'").select("basin", "value_sup")) == [("N", 4.0)]
    assert supply.filter("year > 2050").count() == 0
    index = W.water_scarcity(supply, withdrawal)
    # Q has no base year and Z no withdrawal: neither takes part.
    near(
        rows(index),
        [
            ("s", 2015, "groundwater", 0.5, 0.5), ("s", 2015, "runoff", 0.5, 0.5),
            ("s", 2020, "runoff", (0.8 * 10 + 0.1 * 30) / 40, (0.8 * 5 + 0.1 * 15) / 20),
        ],
    )
    assert W.water_scarcity_runoff(index).columns == ["scenario", "year", "resource", "index_wd"]


def test_unknown_withdrawal_makes_the_index_unknown(water_tables):
    runoff, curves, wd, ground = water_tables
    lost = wd.withColumn("value", F.when(~((F.col("year") == 2020) & (F.col("runoff water") == "M")), F.col("value")))
    index = W.water_scarcity(W.water_supply(runoff, curves), W.water_withdrawal(lost, ground))
    got = {(r.year, r.resource): r.index_wd for r in index.collect()}
    assert got[2020, "runoff"] is None and got[2015, "runoff"] == pytest.approx(0.5)


def test_land_projection(spark):
    land = spark.createDataFrame(
        [
            ("s", "A", leaf, "km2", y, v)
            for leaf, y, v in (
                ("Hardwood_Forest_Nile", 2020, 1.0), ("Softwood_Forest_Nile", 2020, 2.0),
                ("Corn_Nile_IRR_hi", 2020, 3.0), ("Corn_Nile_RFD", 2050, 4.0), ("Corn_Nile", 1975, 5.0),
                ("Corn_Elsewhere", 2020, 6.0),
            )
        ],
        "scenario string, region string, landleaf string, Units string, year int, value double",
    )
    basins = spark.createDataFrame([(7, "Nile")], "basin_id int, GLU_name string")
    wide = L.land_projection(land, basins, [2020, 2050])
    assert rows(wide) == [
        ("A", "Corn", 7, "s", None, None), ("A", "CornIRRhi", 7, "s", 3.0, None),
        ("A", "CornRFDNA", 7, "s", None, 4.0), ("A", "Forest", 7, "s", 3.0, None),
    ]
    clash = land.limit(1).withColumn("landleaf", F.lit("Corn_Nile_IRR_hi_x")).unionByName(land)
    with pytest.raises(PySparkException, match="two land leaves"):
        L.land_projection(clash, basins, [2020, 2050]).collect()


MEMBERS = ("forest", "pasture", "corn_irrigated", "corn_rainfed", "otherarableland", "water", "basin_id")
GRID = "scenario string, year int, lon double, lat double, landclass string, value double"


@pytest.fixture(scope="module")
def grid(spark):
    cells = []
    for i, (lon, lat) in enumerate(((1.0, 1.0), (2.0, 1.0), (9.0, 9.0))):
        for year in (2020, 2050):
            for k, m in enumerate(MEMBERS):
                value = None if (lon, year, m) == (2.0, 2050, "water") else float(k + i + (year == 2050))
                cells.append(("s", year, lon, lat, m, value))
    return spark.createDataFrame(cells, GRID)


def test_grid_classes_keep_whole_cells_only(grid, spark):
    got = rows(L.grid_classes(grid, MEMBERS).drop("scenario"))
    assert got == [
        (2020, 1.0, 1.0, 0.0, 1.0, 2.0, 7.0), (2020, 2.0, 1.0, 1.0, 2.0, 3.0, 9.0),
        (2020, 9.0, 9.0, 2.0, 3.0, 4.0, 11.0), (2050, 1.0, 1.0, 1.0, 2.0, 3.0, 9.0),
        (2050, 9.0, 9.0, 3.0, 4.0, 5.0, 13.0),
    ]
    mask = spark.createDataFrame([(1.0, 1.0)], "lon double, lat double")
    assert L.grid_classes(grid, MEMBERS, mask=mask).count() == 2
    with pytest.raises(PySparkException, match="occurs twice"):
        L.grid_classes(grid.unionAll(grid), MEMBERS).collect()


def test_periods_equal_two_class_frames(grid):
    both = L.grid_periods(grid, MEMBERS)
    assert both.count() == 2
    one = L.grid_classes(grid, MEMBERS)
    a = {(r.lon, r.lat): r for r in one.filter("year = 2020").collect()}
    b = {(r.lon, r.lat): r for r in one.filter("year = 2050").collect()}
    for r in both.collect():
        for c in ("forest", "pasture", "crop_irr", "crop_rfd"):
            assert r[f"{c}_0"] == a[r.lon, r.lat][c] and r[f"{c}_1"] == b[r.lon, r.lat][c]


def test_species_loss(grid, spark):
    cell_map = spark.createDataFrame([(1.0, 1.0, 1), (1.0, 1.0, 2), (2.0, 1.0, 1)], "lon double, lat double, OBJECTID int")
    ecoregions = spark.createDataFrame([(1, "E"), (2, "E"), (3, "F"), (4, "G")], "OBJECTID int, eco_code string")
    names = spark.createDataFrame([("E", "Eee"), ("F", "Eff")], "ECOREGION_CODE string, ECO_NAME string")
    areas = L.ecoregion_areas(L.grid_periods(grid, MEMBERS), cell_map, ecoregions, names, ["s", "empty"])
    by_code = {(r.scenario, r.ECOREGION_CODE): r for r in areas.collect()}
    assert set(by_code) == {("s", "E"), ("s", "F"), ("empty", "E"), ("empty", "F")}
    # The cell lies in two polygons of the same code, so it counts twice.
    assert by_code["s", "E"].crop_rfd_0 == 2 * 7.0e6 and by_code["s", "E"].crop_rfd_diff == 2 * 2.0e6
    assert by_code["s", "F"].crop_rfd_0 == by_code["empty", "E"].forest_diff == 0.0
    observed = L.ecoregion_areas(L.grid_periods(grid, MEMBERS), cell_map, ecoregions, names)
    assert [r for r in rows(areas) if r[:2] == ("s", "E")] == rows(observed)
    factors = spark.createDataFrame(
        [("E", 1e-6, 2e-6, 3e-6, 4e-6)],
        "ECOREGION_CODE string, Forest_CF double, Pasture_CF double, Irrigated_crop_CF double, Rainfed_crop_CF double",
    )
    loss = L.species_loss(areas, factors)
    near(rows(loss), [("empty", 0.0, 0.0, 0.0, 0.0, 0.0), ("s", 2.0, 4.0, 6.0, 16.0, 28.0)])
    per_ha = L.species_loss(areas, factors, m2_per_factor_unit=1e4).filter("scenario = 's'").first()
    assert per_ha.final_PSL == pytest.approx(28e-4)
    assert "forest_PSL" not in L.species_loss(areas, factors, faithful=True).columns


RUNS = [
    ("base_SSP1", 2020, 2.0), ("base_SSP1", 2030, 4.0), ("x_trn10_SSP1", 2020, 3.0), ("x_trn10_SSP1", 2030, 6.0),
    ("x_bldtrn20_SSP1", 2020, 2.0), ("x_bldtrn20_SSP1", 2030, 2.0), ("x_trn10_SSP1", 1990, 99.0),
    ("base_SSP2", 2020, 1.0), ("x_trn10_SSP2", 2020, 2.0), ("x_noSector10_SSP2", 2020, 5.0), ("other", 2020, 1.0),
]


@pytest.fixture(scope="module")
def runs(spark):
    return spark.createDataFrame(RUNS, "scenario string, year int, v double")


def test_compare_relative_and_absolute(runs):
    rel = C.mean_difference(runs, "v", "u", "Economy", relative=True)
    near(rows(rel.select("scenario", "diff")), [("x_bldtrn20_SSP1", -0.25), ("x_noSector10_SSP2", 4.0), ("x_trn10_SSP1", 0.5), ("x_trn10_SSP2", 1.0)])
    wide = C.compare(runs, "v", "u", "Water", ssps=("SSP1", "SSP2"))
    got = {r.Gt_CO2_reduction: r for r in wide.collect()}
    assert got[10.0].trn_ssp1 == 1.5 and got[10.0].trn_ssp2 == 1.0 and got[10.0].a_ssp2 == 4.0
    assert got[20.0].trn_ssp1 == -1.0 and got[20.0].trn_ssp2 is None


def test_compare_needs_every_baseline_year(runs):
    with pytest.raises(PySparkException, match="no baseline for"):
        C.mean_difference(runs.filter("NOT (scenario = 'base_SSP1' AND year = 2030)"), "v", "u", "w").collect()


def test_a_baseline_against_itself_is_zero(runs):
    same = runs.filter("scenario = 'base_SSP1'")
    twin = same.withColumn("scenario", F.lit("x_trn5_SSP1"))
    assert C.mean_difference(same.unionByName(twin), "v", "u", "w").first()["diff"] == 0.0


def test_two_runs_in_one_cell_fail(runs):
    twin = runs.filter("scenario = 'x_trn10_SSP1'").withColumn("scenario", F.lit("y_trn10_SSP1"))
    with pytest.raises(PySparkException, match="more than one row"):
        C.compare(runs.unionByName(twin), "v", "u", "w").collect()


def test_compare_legacy(spark):
    df = spark.createDataFrame(
        [("inc_base", 2020, 1.0), ("inc_trn_10", 2020, 3.0), ("inc_sup_20", 2020, 0.5)], "scenario string, year int, v double"
    )
    got = {r.Gt_CO2_reduction: r for r in C.compare_legacy(df, "v", "inc_base", "u", "s").collect()}
    assert got["10"].trn == 2.0 and got["20"].sup == -0.5 and got["20"].trn is None


def test_scalar_difference(spark):
    df = spark.createDataFrame(
        [("base_SSP1", 2.0), ("x_trn10_SSP1", 5.0), ("x_trn10_SSP2", 9.0)], "scenario string, value double"
    )
    got = C.scalar_difference(df, "value", "PSL", "PSL", "SSP1")
    assert rows(got) == [("x_trn10_SSP1", "SSP1", "PSL", "PSL", 3.0)]
    by_family = C.mean_difference(df.filter("scenario LIKE '%SSP1'"), "value", "PSL", "PSL")
    assert rows(by_family) == rows(got)


def test_deliverable_keeps_levels_of_all_families(runs):
    blocks = [C.mean_difference(runs, "v", "u", name) for name in ("Water", "Health")]
    report = C.deliverable(blocks[0].unionByName(blocks[1]), ("SSP1", "SSP2"))
    assert report.columns[:4] == ["Gt_CO2_reduction", "unit", "sdg", "afolu_ssp1"]
    assert len(report.columns) == 3 + 12 and "a_ssp2" not in report.columns
    got = report.collect()
    assert [(r.sdg, r.Gt_CO2_reduction) for r in got] == [("Health", 10.0), ("Water", 10.0)]
    assert got[0].trn_ssp1 == 1.5 and got[0].trn_ssp2 == 1.0


def test_two_leaves_of_a_basin_without_an_id_are_no_clash(spark):
    schema = "scenario string, region string, landleaf string, Units string, year int, value double"
    land = spark.createDataFrame(
        [("s", "A", "Corn_Elsewhere_IRR_hi", "km2", 2020, 1.0), ("s", "A", "Corn_Elsewhere_IRR_hi_x", "km2", 2020, 2.0),
         ("s", "A", "Corn_Nile", "km2", 2020, 3.0)], schema,
    )
    basins = spark.createDataFrame([(7, "Nile")], "basin_id int, GLU_name string")
    assert rows(L.land_projection(land, basins, [2020])) == [("A", "Corn", 7, "s", 3.0)]


def test_grid_of_many_classes_nan_and_unlisted_ones(spark):
    names = [f"class{i}" for i in range(100)]
    cells = [("s", y, float(x), 1.0, n, 1.0) for x in (1, 2) for y in (2020, 2050) for n in (*names, "basin_id")]
    cells[0] = (*cells[0][:5], float("nan"))
    df = spark.createDataFrame(cells, GRID)
    whole = L.grid_classes(df, names, keep=("class1",))
    assert rows(whole.select("year", "lon", "class1")) == [(2020, 2.0, 1.0), (2050, 1.0, 1.0), (2050, 2.0, 1.0)]
    assert L.grid_periods(df, names, keep=("class1",)).count() == 1
    with pytest.raises(PySparkException, match="not listed"):
        L.grid_classes(df, names[:99], keep=("class1",)).collect()


def test_units_that_differ_lose_no_basin(spark):
    keys = "scenario string, basin string, subresource string, year int, Units string"
    supply = spark.createDataFrame([("s", "N", "runoff", 2015, "km3", 10.0), ("s", "N", "runoff", 2020, "km3", 8.0)], f"{keys}, value_sup double")
    withdrawal = spark.createDataFrame([("s", "N", "runoff", 2015, "km^3", 5.0), ("s", "N", "runoff", 2020, "km3", 4.0)], f"{keys}, value_wd double")
    got = {r.year: (r.index_sup, r.index_wd) for r in W.water_scarcity(supply, withdrawal).collect()}
    assert got == {2015: (None, None), 2020: (0.5, 0.5)}


def test_report_cells_go_by_family(spark):
    """A family inside a longer name, and one before the sector, have their cells all the same."""
    names = ["study_base_SSP2", "study_trn10_SSP2x", "study_SSP2_bld10"]
    df = spark.createDataFrame([(n, y, float(i + 1)) for i, n in enumerate(names) for y in (2030, 2050)], "scenario string, year int, v double")
    got = C.compare(df, "v", "u", "x", ssps=("SSP2",)).collect()
    cells = {(r["trn_ssp2"], r["bld_ssp2"]) for r in got}
    assert {a for a, _ in cells} | {b for _, b in cells} >= {1.0, 2.0}
