"""Scalar column functions used by the indicators and the comparison report."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, functions as F

from scenlens.functions.fixed_values import DB_PREFIX, PROJECT_SUFFIX, SECTOR_PRECEDENCE


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_number(c: str | Column) -> Column:
    """The digits and dots of a label as a number ('resid heating_d10' -> 10.0); null when there are none."""
    return F.regexp_replace(_col(c), "[^0-9.]", "").try_cast("double")


def single_number(c: str | Column) -> Column:
    """The only run of digits in the text. A label with none or with several is an error, not a guess."""
    c = _col(c)
    runs = F.regexp_extract_all(c, F.lit(r"(\d+)"), F.lit(1))
    return (
        F.when(c.isNull(), F.lit(None).cast("double"))
        .when(
            F.size(runs) != 1,
            F.raise_error(F.concat(F.lit("expected exactly one number in: "), c)).cast("double"),
        )
        .otherwise(F.get(runs, F.lit(0)).cast("double"))
    )


def sector_of(c: str | Column, order: tuple[str, ...] = SECTOR_PRECEDENCE, default: str = "a") -> Column:
    """First sector of ``order`` whose name occurs in the scenario label."""
    c = _col(c)
    found = F.coalesce(*[F.when(c.contains(name), F.lit(name)) for name in order], F.lit(default))
    return F.when(c.isNotNull(), found)


def split_first(c: str | Column, sep: str = ",") -> Column:
    """Text before the first separator."""
    return F.substring_index(_col(c), sep, 1)


def split_padded(c: str | Column, sep: str, n: int) -> list[Column]:
    """Exactly ``n`` parts: absent ones are null, surplus ones are dropped."""
    parts = F.split(_col(c), re.escape(sep), -1)
    return [F.get(parts, F.lit(i)) for i in range(n)]


def split_last(c: str | Column, sep: str = "_") -> tuple[Column, Column]:
    """(head, tail) around the last separator; without a separator the head is the text and the tail null."""
    c = _col(c)
    tail = F.substring_index(c, sep, -1)
    head = F.substring(c, F.lit(1), F.length(c) - F.length(tail) - F.lit(len(sep)))
    has = c.contains(sep)
    return F.when(has, head).otherwise(c), F.when(has, tail)


def land_class(landclass: str | Column, irrigation: str | Column, level: str | Column) -> Column:
    """Class name with irrigation and level appended when the leaf is irrigated or rainfed.

    A leaf with an irrigation type but no level gets the text ``NA`` appended, as the downstream
    downscaling model expects.
    """
    landclass, irrigation, level = _col(landclass), _col(irrigation), _col(level)
    return F.when(
        irrigation.isNotNull(), F.concat(landclass, irrigation, F.coalesce(level, F.lit("NA")))
    ).otherwise(landclass)


def pct(num: str | Column, den: str | Column) -> Column:
    """100 x num / den; null for a zero denominator."""
    return F.try_divide(100 * _col(num), _col(den))


def diff(x: str | Column, base: str | Column, relative: bool = False) -> Column:
    """Difference from the baseline, as a fraction of the baseline if ``relative``."""
    x, base = _col(x), _col(base)
    return F.try_divide(x - base, base) if relative else x - base


def deflate(c: str | Column, factor: float) -> Column:
    """Convert between currency years with a price-index ratio, see :func:`deflator`."""
    return _col(c) * F.lit(float(factor))


def deflator(index: dict[int, float], to_year: int, from_year: int) -> float:
    """Price-index ratio that turns ``from_year`` currency into ``to_year`` currency."""
    return index[to_year] / index[from_year]


def project_name(c: str | Column) -> Column:
    """Project label of an output: the project file name without its database prefix and extension."""
    return F.regexp_replace(_col(c), rf"^{DB_PREFIX}|\Q{PROJECT_SUFFIX}\E$", "")


def project_db_name(name: str | Column, ssp: str | Column) -> Column:
    """Database name of a study for one SSP family, or of its baseline when ``ssp`` is 'base'."""
    name, ssp = _col(name), _col(ssp)
    return F.concat(
        F.lit(DB_PREFIX),
        F.when(ssp == "base", F.concat_ws("_", name, ssp)).otherwise(
            F.concat_ws("_", F.upper(ssp), name)
        ),
    )


def row_sum(cols: list[str]) -> Column:
    """Sum across columns of one row; null if any of them is null."""
    return reduce(lambda a, b: a + b, [F.col(f"`{c}`") for c in cols])
