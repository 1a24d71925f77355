"""Land use by class, ecoregion areas and potential species loss.

The grid is the one large input: cells x classes x years x scenarios. It is shuffled once, on (scenario,
cell), with both years and all classes combined into one row per cell map-side.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from scenlens.functions.fixed_values import KM2_TO_M2, LAND_YEARS, NON_LAND_VARIABLES, PSL_CLASSES
from scenlens.functions.scalars import land_class, row_sum, split_padded
from scenlens.operators.aggregation import sum_by
from scenlens.operators.joins import cross_scenarios, full_join, inner_join
from scenlens.operators.reshape import all_members, member_masks
from scenlens.operators.rows import map_numeric, zero_fill


def land_projection(land: DataFrame, basins: DataFrame, years: Sequence[int]) -> DataFrame:
    """Land by class and basin, one column per year: (region, landclass, metric_id, scenario, <years>).

    Leaves read ``class_basin[_irrigation[_level]]``; the two managed forest kinds count as forest. Basins
    without an id are left out. Two different leaves that end up in one cell fail.
    """
    leaf = F.col("landleaf")
    for kind in ("Hardwood_Forest", "Softwood_Forest"):
        leaf = F.replace(leaf, F.lit(kind), F.lit("Forest"))
    landclass, basin, irrigation, level = split_padded(leaf, "_", 4)
    rows = land.select(
        "scenario",
        "region",
        land_class(landclass, irrigation, level).alias("landclass"),
        basin.alias("GLU_name"),
        "year",
        "value",
        F.xxhash64(leaf, "Units").alias("leaf"),
    )
    ids = basins.select("GLU_name", F.col("basin_id").alias("metric_id"))
    rows = inner_join(rows, ids, ["GLU_name"])

    def cell(y: int) -> Column:
        here = F.col("year") == y
        total = F.sum(F.when(here, F.col("value")))
        return F.when(F.count_if(here & F.col("value").isNull()) == 0, total).alias(str(y))

    def two_leaves(y: int) -> Column:
        leaf = F.when(F.col("year") == y, F.col("leaf"))
        return F.coalesce(F.min(leaf) != F.max(leaf), F.lit(False))

    twice = reduce(or_, [two_leaves(y) for y in years])
    wide = rows.groupBy("region", "landclass", "GLU_name", "metric_id", "scenario").agg(
        twice.alias("__twice"), *[cell(y) for y in years]
    )
    message = F.concat(
        F.lit("two land leaves in one row: "), F.to_json(F.struct("region", "landclass", "GLU_name"))
    )
    one = F.when(F.col("__twice"), F.raise_error(message)).otherwise(F.lit(True))
    return wide.filter(one).select(
        "region", "landclass", "metric_id", "scenario", *[F.col(f"`{y}`") for y in years]
    )


def _class_sums(cond: Column | None, suffix: str, keep: Sequence[str]) -> list[Column]:
    """Per cell: irrigated crops, rainfed crops with other arable land, and the kept classes."""
    name = F.col("landclass")
    tests = {c: name == c for c in keep}
    tests["crop_irr"] = name.contains("irrigated")
    tests["crop_rfd"] = name.contains("rainfed") | name.contains("otherarableland")
    out = []
    for c, test in tests.items():
        hit = test if cond is None else test & cond
        out.append(F.coalesce(F.sum(F.when(hit, F.col("value"))), F.lit(0.0)).alias(c + suffix))
    return out


def _members(grid: DataFrame, members: Sequence[str], mask: DataFrame | None) -> DataFrame:
    """The land classes' cells with a value, neither null nor NaN; variables that are no class may be left out."""
    land = ~F.col("landclass").isin(*[v for v in NON_LAND_VARIABLES if v not in members])
    rows = grid.filter(land & F.col("value").isNotNull() & ~F.isnan("value"))
    return rows if mask is None else rows.join(mask.select("lon", "lat"), ["lon", "lat"], "left_semi")


def _whole(masks: list[tuple[Column, int]], prefix: str, n_col: str) -> Column:
    """True for a cell with each member exactly once; fails on a repeated member and on one not listed."""
    known = sum((F.coalesce(F.bit_count(f"{prefix}{i}"), F.lit(0)) for i in range(len(masks))), F.lit(0))
    message = F.concat(
        F.lit("a land class occurs twice or is not listed in cell "), F.to_json(F.struct("lon", "lat"))
    )
    return F.when(F.col(n_col) > known, F.raise_error(message)).otherwise(all_members(masks, prefix))


def grid_classes(
    grid: DataFrame,
    members: Sequence[str],
    keep: Sequence[str] = ("forest", "pasture"),
    mask: DataFrame | None = None,
) -> DataFrame:
    """(scenario, year, lon, lat, <keep>, crop_irr, crop_rfd) of the cells that have every member."""
    masks = member_masks("landclass", members)
    found = [F.bit_or(bit).alias(f"__mask{i}") for i, (bit, _) in enumerate(masks)]
    cells = (
        _members(grid, members, mask)
        .groupBy("scenario", "year", "lon", "lat")
        .agg(*found, F.count(F.lit(1)).alias("__n"), *_class_sums(None, "", keep))
    )
    return cells.filter(_whole(masks, "__mask", "__n")).drop("__n", *[f"__mask{i}" for i in range(len(masks))])


def grid_periods(
    grid: DataFrame,
    members: Sequence[str],
    keep: Sequence[str] = ("forest", "pasture"),
    mask: DataFrame | None = None,
    years: tuple[int, int] = LAND_YEARS,
) -> DataFrame:
    """``grid_classes`` of two years side by side (``_0``, ``_1``) for cells whole in both.

    One group-by in place of two filtered ones and a join.
    """
    masks = member_masks("landclass", members)
    aggs, extra = [], []
    for i, y in enumerate(years):
        here = F.col("year") == y
        aggs += [
            *[F.bit_or(F.when(here, bit)).alias(f"__mask{i}_{j}") for j, (bit, _) in enumerate(masks)],
            F.count_if(here).alias(f"__n{i}"),
            *_class_sums(here, f"_{i}", keep),
        ]
        extra += [f"__n{i}", *[f"__mask{i}_{j}" for j in range(len(masks))]]
    rows = _members(grid, members, mask).filter(F.col("year").isin(*years))
    cells = rows.groupBy("scenario", "lon", "lat").agg(*aggs)
    for i in range(2):
        cells = cells.filter(_whole(masks, f"__mask{i}_", f"__n{i}"))
    return cells.drop(*extra)


def ecoregion_areas(
    periods: DataFrame,
    cell_map: DataFrame,
    ecoregions: DataFrame,
    names: DataFrame,
    scenarios: Sequence[str] | None = None,
    classes: Sequence[str] = PSL_CLASSES,
) -> DataFrame:
    """Class areas in m2 and their change per ecoregion: (scenario, ECOREGION_CODE, ECO_NAME, ...).

    ``cell_map`` (lon, lat, OBJECTID) is the reusable result of the point-in-polygon join; ``ecoregions``
    (OBJECTID, eco_code) may give several polygons one code; ``names`` (ECOREGION_CODE, ECO_NAME) selects
    the reported ones. Ecoregions without cells count as zero in every listed scenario; without a list
    they have no row, which changes no total.
    """
    cols = [f"{c}_{i}" for i in (0, 1) for c in classes]
    placed = inner_join(periods, cell_map.select("lon", "lat", "OBJECTID"), ["lon", "lat"])
    by_polygon = sum_by(placed, ["scenario", "OBJECTID"], *cols)
    codes = ecoregions.select("OBJECTID", F.col("eco_code").alias("ECOREGION_CODE"))
    if scenarios is None:
        every = inner_join(by_polygon, codes, ["OBJECTID"])
    else:
        every = full_join(by_polygon, cross_scenarios(codes, scenarios), ["scenario", "OBJECTID"])
    filled = zero_fill(every, ["OBJECTID"])
    named = inner_join(filled, names.select("ECOREGION_CODE", "ECO_NAME"), ["ECOREGION_CODE"])
    areas = sum_by(named, ["scenario", "ECOREGION_CODE", "ECO_NAME"], *cols)
    areas = map_numeric(areas, lambda c: c * KM2_TO_M2)
    return areas.withColumns({f"{c}_diff": F.col(f"{c}_1") - F.col(f"{c}_0") for c in classes})


def species_loss(
    areas: DataFrame,
    factors: DataFrame,
    m2_per_factor_unit: float = 1.0,
    faithful: bool = False,
) -> DataFrame:
    """Potential species loss per class and in total: (scenario, <class>_PSL, final_PSL).

    ``factors``: ECOREGION_CODE, Forest_CF, Pasture_CF, Irrigated_crop_CF, Rainfed_crop_CF, in species per
    ``m2_per_factor_unit`` square metres. ``faithful`` leaves out the forest column, which existing
    result files lack although their total includes it.
    """
    pairs = {
        "forest": "Forest_CF",
        "pasture": "Pasture_CF",
        "crop_irr": "Irrigated_crop_CF",
        "crop_rfd": "Rainfed_crop_CF",
    }
    loss = inner_join(areas, factors.select("ECOREGION_CODE", *pairs.values()), ["ECOREGION_CODE"])
    parts = [f"{c}_PSL" for c in pairs]
    loss = loss.withColumns(
        {f"{c}_PSL": F.col(f"{c}_diff") / m2_per_factor_unit * F.col(cf) for c, cf in pairs.items()}
    ).withColumn("final_PSL", row_sum(parts))
    total = sum_by(loss, ["scenario"], *parts, "final_PSL")
    return total.drop("forest_PSL") if faithful else total
