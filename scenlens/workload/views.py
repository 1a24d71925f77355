"""Model-shaped tables derived from the driver's tables.

A market segment plays the scenario, a nation the region, a region the macro-region, an order year the
model year. Each builder reads only the tables and columns it needs.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from scenlens.operators.joins import cross_scenarios, left_join
from scenlens.sources.shared import staged

# The market segments and order years of the input tables, and how many deciles there are.
SCENARIOS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
BASELINE = "BUILDING"
YEARS = (1995, 1996, 1997, 1998, 1999, 2000, 2001)
DECILES = tuple(range(1, 11))
BASE_YEAR, REPORT_FROM, REPORT_TO = 1995, 1997, 2001

# Part types and the groups, gases and land classes they stand for. PROMO has no group.
TYPE_GROUPS = {
    "SMALL": "light", "MEDIUM": "light", "LARGE": "heavy", "STANDARD": "heavy", "ECONOMY": "light",
}
FOOD_TYPES = {
    "FoodDemand_Staples": ("SMALL", "MEDIUM", "LARGE"),
    "FoodDemand_NonStaples": ("STANDARD", "ECONOMY", "PROMO"),
}
LAND_CLASSES = {
    "SMALL": "forest", "LARGE": "pasture", "MEDIUM": "corn_irrigated", "STANDARD": "corn_rainfed",
    "ECONOMY": "otherarableland", "PROMO": "water",
}
STUDY_SECTORS = {"AUTOMOBILE": "trn", "FURNITURE": "bld", "HOUSEHOLD": "afolu", "MACHINERY": "ind"}


def _literals(values) -> Column:
    return F.explode(F.array(*[F.lit(v) for v in values]))


def _known(c: Column, values, what: str) -> Column:
    """``c``, but the job fails on a value outside the list that the views are built on."""
    message = F.concat(F.lit(f"unknown {what}: "), c.cast("string"))
    return F.when(c.isNull() | c.isin(*values), c).otherwise(F.raise_error(message))


def _exact_mean(c: str) -> Column:
    """Mean of a money column from an exact sum: the same double whatever the order of the rows."""
    total = F.sum(F.col(c).cast("decimal(18,2)"))
    return total.cast("double") / F.count(F.lit(1))


_schemas: dict[str, StructType] = {}


def _once(build):
    """Build a view's plan once per ``Views``."""

    @wraps(build)
    def get(self) -> DataFrame:
        if build.__name__ not in self._built:
            self._built[build.__name__] = build(self)
        return self._built[build.__name__]

    return get


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir
        self._built: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """An input table. Its footers are read for the schema the first time only."""
        path = f"{self.dir}/{name}.parquet"
        if path not in _schemas:
            _schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_schemas[path]).parquet(path)

    @_once
    def nations(self) -> DataFrame:
        return self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        ).select(
            "n_nationkey",
            F.col("n_name").alias("region"),
            F.col("r_name").alias("super_region"),
            F.col("r_regionkey").alias("super_key"),
        )

    @_once
    def spine(self) -> DataFrame:
        """Every scenario, region and year: generated per nation from the fixed lists."""
        every = cross_scenarios(self.nations(), SCENARIOS)
        return every.select("scenario", "region", "super_region", _literals(YEARS).alias("year"))

    @_once
    def obs(self) -> DataFrame:
        year = _known(F.year("o_orderdate").cast("int"), YEARS, "order year")
        return (
            self.table("orders")
            .join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(self.nations(), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                "o_orderkey",
                "o_custkey",
                _known(F.col("c_mktsegment"), SCENARIOS, "market segment").alias("scenario"),
                "region",
                "super_region",
                "super_key",
                year.alias("year"),
                (F.col("o_custkey") % 10 + 1).cast("int").alias("decile"),
                F.col("o_orderpriority").alias("title"),
                F.col("o_totalprice").alias("value"),
            )
        )

    @_once
    def pop(self) -> DataFrame:
        customers = (
            self.table("customer")
            .join(self.nations(), F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy(F.col("c_mktsegment").alias("scenario"), "region")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        growth = 1 + F.lit(0.01) * (F.col("year") - BASE_YEAR)
        return left_join(self.spine(), customers, ["scenario", "region"]).select(
            "scenario",
            "region",
            "super_region",
            "year",
            ((1 + F.coalesce("n", F.lit(0))) * growth).cast("double").alias("value"),
        )

    @_once
    def gdp(self) -> DataFrame:
        keys = ["scenario", "region", "year"]
        mean = self.obs().groupBy(*keys).agg((_exact_mean("value") / 1000).alias("v"))
        return left_join(self.spine().select(*keys), mean, keys).select(
            *keys, F.coalesce("v", F.lit(1.0)).alias("value")
        )

    @_once
    def income(self) -> DataFrame:
        keys = ["scenario", "region", "year", "decile"]
        mean = self.obs().groupBy(*keys).agg((_exact_mean("value") / 1000).alias("v"))
        cells = self.spine().select("scenario", "region", "year", _literals(DECILES).alias("decile"))
        return left_join(cells, mean, keys).select(
            "scenario",
            "region",
            "year",
            F.concat(F.lit("resid_d"), F.col("decile")).alias("consumer"),
            F.coalesce("v", F.lit(1.0)).alias("value"),
        )

    def service(self, part: bool = True) -> DataFrame:
        """Order lines with their order's cell. Without ``part`` the join on parts is left out."""
        obs = self.obs().select(
            "o_orderkey", "scenario", "region", "super_region", "super_key", "year", "decile"
        )
        lines = self.table("lineitem").join(obs, F.col("l_orderkey") == F.col("o_orderkey"))
        if part:
            lines = lines.join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
        cols = [F.col("p_type").alias("technology")] if part else []
        return lines.select(
            "scenario",
            "region",
            "super_region",
            "super_key",
            "year",
            "decile",
            F.concat(F.lit("resid_d"), F.col("decile")).alias("consumer"),
            *cols,
            F.col("l_returnflag").alias("flag"),
            F.col("l_linestatus").alias("status"),
            "l_partkey",
            "l_suppkey",
            F.col("l_quantity").alias("demand"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("cost"),
            F.col("l_discount").alias("discount"),
        )

    def lines(self) -> DataFrame:
        """Order lines with their part's type, for queries that need nothing of the order."""
        return (
            self.table("lineitem")
            .join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
            .select(
                F.col("p_type").alias("technology"),
                F.col("l_quantity").alias("demand"),
                F.col("l_discount").alias("discount"),
            )
        )

    @_once
    def household(self) -> DataFrame:
        """Mean cost and demand per scenario, region, year and decile; at most one row per cell."""
        keys = ["scenario", "region", "year", "decile"]
        seen = (
            self.service(part=False)
            .groupBy(*keys)
            .agg(F.avg("cost").alias("c"), F.sum("demand").alias("d"))
        )
        cells = self.spine().select("scenario", "region", "year", _literals(DECILES).alias("decile"))
        full = left_join(cells, seen, keys).select(
            "scenario",
            "region",
            "year",
            F.concat(F.lit("resid_d"), F.col("decile")).alias("consumer"),
            F.coalesce("c", F.lit(1.0)).alias("cost"),
            F.coalesce("d", F.lit(1.0)).alias("demand"),
        )
        return staged(full, "household")

    @_once
    def water(self) -> DataFrame:
        source = F.when(F.col("status") == "O", "runoff").otherwise(
            F.concat(F.lit("groundwater"), F.col("flag"))
        )
        cells = (
            self.service(part=False)
            .groupBy("scenario", F.col("region").alias("basin"), "year", source.alias("subresource"))
            .agg(
                F.sum("demand").alias("supply"),
                F.sum(F.col("demand") * (1 - F.col("discount"))).alias("withdrawal"),
            )
        )
        return staged(cells.withColumn("Units", F.lit("km^3")), "water")

    def water_tables(self) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        """Available runoff, supply curves, withdrawn runoff, withdrawn groundwater."""
        water = self.water()
        surface = water.filter(F.col("subresource") == "runoff")
        ground = water.filter(F.col("subresource") != "runoff")

        def shaped(df: DataFrame, basin: str, value: str) -> DataFrame:
            return df.select(
                "scenario", F.col("basin").alias(basin), "subresource", "Units", "year",
                F.col(value).alias("value"),
            )

        return (
            shaped(surface, "basin", "supply"),
            shaped(ground, "resource", "supply"),
            shaped(surface, "runoff water", "withdrawal"),
            shaped(ground, "groundwater", "withdrawal"),
        )

    @_once
    def grid(self) -> DataFrame:
        landclass = F.lit(None).cast("string")
        for p_type, name in LAND_CLASSES.items():
            landclass = F.when(F.col("technology") == p_type, name).otherwise(landclass)
        return (
            self.service()
            .groupBy(
                "scenario",
                F.when(F.col("year") < 1999, 2020).otherwise(2050).alias("year"),
                (F.col("l_partkey") % 12 * 30 - 165).cast("double").alias("lon"),
                (F.col("l_suppkey") % 6 * 30 - 75).cast("double").alias("lat"),
                landclass.alias("landclass"),
            )
            .agg(F.sum("demand").alias("value"))
        )

    def points(self) -> DataFrame:
        return self.table("embeddings").select(
            "vec_id",
            F.col("embedding")[0].cast("double").alias("x"),
            F.col("embedding")[1].cast("double").alias("y"),
        )

    @_once
    def runs(self) -> DataFrame:
        """Orders under study-like scenario names; one family per macro-region, levels 5 to 20.

        The first family lacks the highest level.
        """
        level = F.when(F.col("super_key") == 0, F.col("o_custkey") % 3).otherwise(
            F.col("o_custkey") % 4
        )
        label = F.lit("base")
        for segment, sector in STUDY_SECTORS.items():
            name = F.concat(F.lit(sector), ((level + 1) * 5).cast("string"))
            label = F.when(F.col("scenario") == segment, name).otherwise(label)
        return self.obs().withColumn(
            "scenario",
            F.concat(F.lit("study_"), label, F.lit("_SSP"), (F.col("super_key") + 1).cast("string")),
        )

    @_once
    def run_cells(self) -> DataFrame:
        """The runs reduced to (scenario, region, year); all report blocks read this one table."""
        half = F.when(F.col("decile") <= 5, F.col("value")).otherwise(0.0)
        cells = (
            self.runs()
            .groupBy("scenario", "region", "year")
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.sum("value").alias("total"),
                F.sum(half).alias("half"),
            )
        )
        return staged(cells, "run_cells")

    def run_tables(self) -> dict[str, DataFrame]:
        """Indicator tables of the runs, in the shape of the gathered outputs."""
        cells = self.run_cells()
        keys = ["scenario", "region", "year"]
        n = F.col("n").cast("double")
        by_year = cells.groupBy("scenario", "year").agg(
            F.sum(n).alias("n"), F.sum("total").alias("total"), F.sum("half").alias("half")
        )
        return {
            "gdp": cells.select(*keys, (F.col("total") / F.col("n") / 1000).alias("value")),
            "pop": cells.select(*keys, n.alias("value")),
            "expenditure": by_year.select(
                "scenario", "year",
                (F.col("total") / F.col("n") / 10000).alias("total_expenditure_per_world"),
            ),
            "food": by_year.select(
                "scenario", "year", F.lit("percentage").alias("units"),
                (100 * F.col("half") / F.col("total")).alias("expenditure_percent_GDP"),
            ),
            "health": cells.select("scenario", F.col("region").alias("model_region"), "year", n.alias("mort")),
            "water": by_year.select(
                "scenario", "year", F.lit("runoff").alias("resource"),
                (F.col("n") / 100).alias("index_sup"),
                (F.col("half") / F.col("n") / 100000).alias("index_wd"),
            ),
            "land": cells.groupBy("scenario").agg((F.sum("total") / 1e6).alias("value")),
        }
