"""Query tables: one long table per title, for all scenarios of a project.

A project is a folder with one Parquet table per title, partitioned by scenario, so that reading some
scenarios prunes files. Schemas are fixed; nothing is inferred.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from scenlens.functions.fixed_values import (
    CO2_LABELS_RESOURCE,
    CO2_LABELS_SECTOR,
    FOOD_GROUPS_BY_INCOME,
    GASES,
)
from scenlens.operators.joins import anti_join, left_join
from scenlens.operators.reshape import union_by_name


def _schema(*dims: str) -> StructType:
    """scenario, the title's own dimensions, Units, year, value."""
    names = ("scenario", *dims, "Units")
    return StructType(
        [StructField(n, StringType()) for n in names]
        + [StructField("year", IntegerType()), StructField("value", DoubleType())]
    )


@dataclass(frozen=True)
class Query:
    """A title's schema, the filter that selects its rows, and the labels it merges."""

    schema: StructType
    where: Callable[[], Column] | None = None
    needs: tuple[str, ...] = ()
    relabel: tuple[str, Mapping[str, str]] | None = None


def _isin(col: str, *members: str) -> Callable[[], Column]:
    return lambda: F.col(col).isin(*members)


def _water(kind: str) -> Callable[[], Column]:
    return lambda: F.col("resource").contains("water withdrawals") & F.col("subresource").contains(kind)


def _building() -> Column:
    return (F.col("sector") == "building") | (F.col("final_energy") == "building")


def _to_co2(labels: Sequence[str]) -> tuple[str, dict[str, str]]:
    return "GHG", dict.fromkeys(labels, "CO2")


_FOOD = _schema("region", "consumer", "nodeinput", "input")
_EMISSIONS = _schema("region", "sector", "subsector", "technology", "GHG")
_WATER_NEEDS = ("resource", "subresource")
_BY_INCOME = dict(where=_isin("consumer", *FOOD_GROUPS_BY_INCOME), needs=("consumer",))

# Titles of the query tables, with their dimensions and row filters.
CATALOG: dict[str, Query] = {
    "food consumption by type (specific)": Query(
        _schema("region", "sector", "subsector_1", "subsector_2", "technology"),
        _isin("sector", "FoodDemand_Staples", "FoodDemand_NonStaples"),
        ("sector",),
    ),
    "food demand prices": Query(_FOOD, _isin("consumer", "FoodDemand"), ("consumer",)),
    "population by region": Query(_schema("region")),
    "GDP per capita PPP by region": Query(
        _schema("region"), _isin("account", "gdp-per-capita-ppp"), ("account",)
    ),
    "ag production by crop type": Query(
        _schema("region", "sector"), _isin("sector_type", "AgSupplySector"), ("sector_type",)
    ),
    "ag production by subsector (land use region)": Query(
        _schema("region", "sector", "subsector", "technology"),
        _isin("sector_type", "AgSupplySector"),
        ("sector_type",),
    ),
    "prices of all markets": Query(_schema("market")),
    "ag commodity prices": Query(
        _schema("region", "sector"), _isin("sector_type", "AgSupplySector"), ("sector_type",)
    ),
    "International Aviation emissions": Query(
        _schema("region", "subsector", "GHG"),
        _isin("subsector", "International Aviation"),
        ("subsector",),
    ),
    "International Shipping emissions": Query(
        _schema("region", "subsector", "GHG"),
        _isin("subsector", "International Ship"),
        ("subsector",),
    ),
    "nonCO2 emissions by resource production": Query(
        _schema("region", "resource", "GHG"),
        lambda: ~F.col("GHG").isin("CO2", "CO2_FUG"),
        ("GHG",),
        _to_co2(CO2_LABELS_RESOURCE),
    ),
    "resource supply curves": Query(_schema("region", "resource", "subresource", "grade")),
    "Basin level available runoff": Query(
        _schema("region", "basin", "subresource"), _water("runoff"), _WATER_NEEDS
    ),
    "Water Withdrawals by Basin (Groundwater)": Query(
        _schema("region", "groundwater", "subresource"), _water("groundwater"), _WATER_NEEDS
    ),
    "Water Withdrawals by Basin (Runoff)": Query(
        _schema("region", "runoff water", "subresource"), _water("runoff"), _WATER_NEEDS
    ),
    "detailed land allocation": Query(_schema("region", "landleaf")),
    "food demand prices by income group": Query(_FOOD, **_BY_INCOME),
    "food demand by income group": Query(_FOOD, **_BY_INCOME),
    "subregional population": Query(_schema("region", "consumer")),
    "subregional income": Query(_schema("region", "consumer")),
    "GDP MER by region": Query(_schema("region"), _isin("account", "GDP"), ("account",)),
    "building service costs": Query(_schema("region", "sector"), _building, ("sector", "final_energy")),
    "building service output by service": Query(
        _schema("region", "sector"), _building, ("sector", "final_energy")
    ),
    "nonCO2 emissions by sector (excluding resource production)": Query(
        _EMISSIONS, _isin("GHG", *GASES), ("GHG",), _to_co2(CO2_LABELS_SECTOR)
    ),
}


def slug(title: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", title.lower()).strip("_")


def _known(title: str) -> Query:
    if title not in CATALOG:
        raise KeyError(f"unknown query title: {title!r}")
    return CATALOG[title]


def read_query(
    spark: SparkSession, root: str, title: str, scenarios: Sequence[str] | None = None
) -> DataFrame:
    """The long table of one title, for all or some scenarios."""
    df = spark.read.schema(_known(title).schema).parquet(f"{root}/{slug(title)}")
    return df if scenarios is None else df.filter(F.col("scenario").isin(*scenarios))


def checked_schema(title: str, df: DataFrame) -> StructType:
    """The title's schema, if the table has its columns."""
    schema = _known(title).schema
    have = {f.name: f.dataType for f in df.schema.fields}
    wrong = [f.name for f in schema.fields if have.get(f.name) != f.dataType]
    if wrong or len(have) != len(schema.fields):
        raise ValueError(f"{title!r} needs {schema.simpleString()}, got {df.schema.simpleString()}")
    return schema


def register_title(root: str, title: str, df: DataFrame, mode: str = "errorifexists") -> None:
    """Add a table to a project under a title. Its columns must be the title's.

    Rows are rebalanced by scenario, so tasks do not each write a file per scenario, and adaptive
    execution splits a large scenario over several files.
    """
    schema = checked_schema(title, df)
    even = df.select(*[f"`{c}`" for c in schema.names]).hint("rebalance", "scenario")
    even.write.mode(mode).partitionBy("scenario").parquet(f"{root}/{slug(title)}")


def where_catalog(df: DataFrame, title: str) -> DataFrame:
    """Keep the raw model rows that belong to a title. Plain predicates, so they reach the file scan."""
    query = _known(title)
    if query.where is None:
        return df
    missing = [c for c in query.needs if c not in df.columns]
    if missing:
        raise ValueError(f"the filter of {title!r} needs columns {missing}")
    return df.filter(query.where())


def rewrite_labels(
    df: DataFrame, col: str, mapping: Mapping[str, str] | DataFrame
) -> DataFrame:
    """Replace labels that occur in ``mapping``; others stay.

    A dict becomes a literal map in the projection. A DataFrame (label, replacement) is joined, with
    Spark's size check deciding on a broadcast.
    """
    if isinstance(mapping, DataFrame):
        label, replacement = mapping.columns
        pairs = mapping.select(
            F.col(label).alias(col), F.col(replacement).alias("__replacement")
        )
        return left_join(df, pairs, [col]).withColumn(
            col, F.coalesce("__replacement", col)
        ).drop("__replacement")
    literal = F.create_map(*[F.lit(v) for v in chain.from_iterable(mapping.items())])
    return df.withColumn(col, F.coalesce(F.try_element_at(literal, F.col(col)), F.col(col)))


def emissions(
    df: DataFrame,
    gases: Sequence[str] = GASES,
    scenarios: Sequence[str] | None = None,
    col: str = "GHG",
    mapping: Mapping[str, str] | None = None,
) -> DataFrame:
    """Emissions rows of the listed gases, with carbon labels merged, for all scenarios in one pass."""
    df = df.filter(F.col(col).isin(*gases))
    if scenarios is not None:
        df = df.filter(F.col("scenario").isin(*scenarios))
    return rewrite_labels(df, col, _to_co2(CO2_LABELS_SECTOR)[1] if mapping is None else mapping)


def list_scenarios(df: DataFrame) -> DataFrame:
    return df.select("scenario").distinct()


def query_coverage(rows: DataFrame) -> DataFrame:
    """(title, n_scenarios, in_all_scenarios) from rows that carry a title and a scenario.

    Pairs are made distinct first, so counting runs over titles x scenarios rather than rows.
    """
    pairs = rows.select("title", "scenario").distinct()
    n = pairs.select("scenario").distinct().agg(F.count(F.lit(1)).alias("n"))
    counted = pairs.groupBy("title").agg(F.count(F.lit(1)).alias("n_scenarios"))
    return counted.withColumn("in_all_scenarios", F.col("n_scenarios") == n.scalar())


def missing_titles(rows: DataFrame, required: DataFrame, in_all: bool = True) -> DataFrame:
    """Required titles (column ``title``) that no scenario, or not every scenario, provides."""
    covered = query_coverage(rows)
    if in_all:
        covered = covered.filter("in_all_scenarios")
    return anti_join(required.select("title"), covered, ["title"])


def check_scenarios(df: DataFrame, desired: Sequence[str] | None = None) -> DataFrame:
    """Rows of the desired scenarios (all if None). The job fails if a desired scenario has no rows."""
    if desired is None:
        return df
    wanted = sorted(set(desired))
    present = df.filter(F.col("scenario").isin(*wanted)).select("scenario").distinct()
    n = present.agg(F.count(F.lit(1)).alias("n")).scalar()
    message = F.lit(f"not every one of these scenarios is available: {', '.join(wanted)}")
    ok = F.when(n < len(wanted), F.raise_error(message)).otherwise(F.lit(True))
    return df.filter(F.col("scenario").isin(*wanted)).filter(ok)


def merge_projects(*tables: DataFrame, by: Sequence[str] = ("title", "scenario")) -> DataFrame:
    """Union of project tables in which an earlier project's (title, scenario) is never overwritten."""
    by = list(by)

    def add(kept: DataFrame, new: DataFrame) -> DataFrame:
        return union_by_name(kept, anti_join(new, kept, by))

    return reduce(add, tables)


def grid_long(df: DataFrame, lon: str = "lon", lat: str = "lat", value: str = "value") -> DataFrame:
    """Rows of gridded variables: arrays over the axes become one row per cell; empty cells are dropped.

    Takes either long rows (lon, lat, value) already, or one row per variable whose ``value`` is the
    flattened lat-major array over the ``lon`` and ``lat`` axis arrays.
    """
    if dict(df.dtypes)[value].startswith("array"):
        rest = [c for c in df.columns if c not in (lon, lat, value)]
        n = F.size(lon)
        cell = df.select(*rest, lon, lat, n.alias("__n"), F.posexplode(value).alias("__i", "__v"))
        df = cell.select(
            *rest,
            F.get(lon, F.col("__i") % F.col("__n")).alias(lon),
            F.get(lat, F.floor(F.col("__i") / F.col("__n")).cast("int")).alias(lat),
            F.col("__v").alias(value),
        )
    filled = F.col(value).isNotNull()
    if dict(df.dtypes)[value] in ("float", "double"):
        filled = filled & ~F.isnan(value)
    return df.filter(filled)
