"""Titles stored in buckets: equal results, joins without a shuffle, sessions that find the tables again."""

import re

import pytest
from pyspark.sql import functions as F

from scenlens.plans import economy
from scenlens.plans import run as R
from scenlens.sources import bucketed as B
from tests.test_jobs import tables

PRICE, OUTPUT = "building service costs", "building service output by service"
FOOD_PRICE, FOOD = "food demand prices by income group", "food demand by income group"
POP, INCOME = "population by region", "subregional income"
YEARS = (2015, 2020, 2030)


@pytest.fixture(scope="module")
def roots(spark, tmp_path_factory):
    """One project stored both ways."""
    root = tmp_path_factory.mktemp("stored")
    titles = tables(spark, ("base_SSP1", "x_SSP1"))
    R.create_project(f"{root}/plain", titles)
    R.create_project(f"{root}/dealt", titles, buckets=3)
    base = tables(spark, ("base_SSP1",))
    R.create_project(f"{root}/plain_base", base)
    R.create_project(f"{root}/dealt_base", base, buckets=3)
    return f"{root}/plain", f"{root}/dealt"


def income_of(spark, root):
    return economy.income_by_decile(R.read_title(spark, root, INCOME), "base", 2030, corrections={})


def energy(spark, root):
    price, output, pop = (R.read_title(spark, root, t) for t in (PRICE, OUTPUT, POP))
    multiplier = spark.createDataFrame([("A", 2.0), ("B", 1.0)], "region string, energy_mult double")
    return economy.energy_share(price, output, pop, F.broadcast(multiplier), income_of(spark, root), 2.0, YEARS)


def food(spark, root):
    price, demand, pop = (R.read_title(spark, root, t) for t in (FOOD_PRICE, FOOD, POP))
    observed = spark.createDataFrame([("A", 2.0), ("B", 1.0)], "region string, av_food_exp double")
    return economy.food_share(price, demand, pop, F.broadcast(observed), income_of(spark, root), 2.0, YEARS, 2015)


def cells(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()))


def exchanges(df):
    text = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return re.findall(r"Exchange hashpartitioning\([^)]*\)", text)


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k in keys:
        spark.conf.unset(k)


def test_stored_tables_are_equal(spark, roots):
    plain, dealt = roots
    for title in tables(spark, ("base_SSP1",)):
        assert cells(R.read_title(spark, plain, title)) == cells(R.read_title(spark, dealt, title))
        assert cells(R.read_title(spark, dealt, title, ["x_SSP1"])) == cells(R.read_title(spark, plain, title, ["x_SSP1"]))
        assert B.is_bucketed(spark, dealt, title) and not B.is_bucketed(spark, plain, title)


def test_the_joins_of_energy_shuffle_no_title(spark, roots, no_broadcast):
    plain, dealt = roots
    with B.copartitioned(spark):
        here = energy(spark, dealt)
        lookup = [x for x in exchanges(here) if re.fullmatch(r"Exchange hashpartitioning\(region#\d+, \d+\)", x)]
        assert exchanges(here) == lookup and len(lookup) <= 1  # the multipliers' check of unique regions
        got = cells(here)
    there = energy(spark, plain)
    assert got == cells(there) and got and len(exchanges(there)) >= 5


def test_the_joins_of_food_shuffle_no_title_before_its_mean(spark, roots, no_broadcast):
    """Food is scaled by a mean over a region's decile, which needs the one shuffle left, of small groups."""
    plain, dealt = roots
    with B.copartitioned(spark):
        here = food(spark, dealt)
        left = exchanges(here)
        got = cells(here)
    there = food(spark, plain)
    assert got == cells(there) and got and len(left) < len(exchanges(there))
    assert not any("input" in x or "consumer" in x for x in left)


def test_another_session_finds_the_buckets(spark, roots):
    """Declared anew, as a session does that has no such table yet."""
    _, dealt = roots
    want = cells(R.read_title(spark, dealt, POP))
    for t in spark.catalog.listTables():
        if t.name.startswith("scenlens_"):
            spark.sql(f"DROP TABLE {t.name}")
    df = R.read_title(spark, dealt, POP)
    assert cells(df) == want
    assert cells(R.read_title(spark, dealt, POP, ["x_SSP1"])) == [r for r in want if "x_SSP1" in r]
    grouped = df.groupBy("region", "year", "scenario").agg(F.sum("value"))
    assert exchanges(grouped) == [] and "Bucketed: true" in grouped._jdf.queryExecution().executedPlan().toString()


def test_existing_titles_and_other_columns_are_refused(spark, roots):
    _, dealt = roots
    pop = tables(spark, ("base_SSP1",))[POP]
    with pytest.raises(FileExistsError):
        B.register_bucketed(spark, dealt, POP, pop, 3)
    with pytest.raises(ValueError, match="needs"):
        B.register_bucketed(spark, dealt + "2", POP, pop.drop("year"), 3)


def test_a_job_reads_buckets_and_leaves_nothing_staged(spark, roots, tmp_path):
    from pathlib import Path

    from scenlens.sources.shared import shared_dir
    from tests.test_jobs import lookups

    plain, dealt = roots
    staged = Path(shared_dir(spark), "scenlens")
    results = []
    for i, root in enumerate(roots):
        looked_up = lookups(spark, ("base_SSP1", "x_SSP1"))
        before = set(staged.glob("*"))
        R.run_indicators(
            spark, root, f"{root}_base", f"{tmp_path}/{i}", "database_basexdb_SSP1_x.dat", "SSP1", looked_up, scenarios=("x_SSP1",)
        )
        assert set(staged.glob("*")) == before
        results.append({n: cells(R.stored(spark, f"{tmp_path}/{i}", n)) for n in ("expenditure", "food", "water")})
    assert results[0] == results[1] and all(results[0].values())
