"""Per-project output files to one table per indicator and SSP family."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from scenlens.sources.files import extract_matching, scan_first, scan_matching


@dataclass(frozen=True)
class Output:
    """Where an indicator's files are and how their rows enter the gathered table.

    ``{ssp}`` in a pattern stands for the family. ``rename`` and ``constants`` shape the result;
    ``distinct`` drops repeated rows within a file.
    """

    folder: str
    columns: str
    pattern: str
    reference_pattern: str
    exclude: str | None = None
    distinct: bool = False
    all_reference_files: bool = False
    rename: Mapping[str, str] = field(default_factory=dict)
    constants: Mapping[str, str] = field(default_factory=dict)


_LONG = "Units string, scenario string, region string, year int, value double"

# Folders, file-name patterns and columns of the per-project outputs.
OUTPUTS: dict[str, Output] = {
    "gdp": Output("SDG1-GDP/indiv_results", _LONG, "{ssp}", "sdgstudy_base"),
    "expenditure": Output(
        "SDG1-Expenditure/indiv_results",
        "scenario string, year int, total_expenditure_per_world double",
        "^SDG1_totalWorldExpPer.*{ssp}",
        "totalWorldExpPer_sdgstudy_base",
        distinct=True,
    ),
    "food": Output(
        "SDG2-Poverty/indiv_results",
        "year int, scenario string, units string, expenditure_percent_GDP double",
        "fbbPerGlobal_{ssp}",
        "fbbPerGlobal_sdgstudy_base",
    ),
    "health": Output(
        "SDG3-Health/mort.fin",
        "scenario string, model_region string, year int, mort double",
        "{ssp}",
        "sdgstudy_base",
    ),
    "water": Output(
        "SDG6-Water/indiv_results",
        "scenario string, year int, resource string, index_sup double, index_wd double",
        "wscarIndex_{ssp}",
        "wscarIndex_sdgstudy_base",
    ),
    "land": Output(
        "SDG15-Land/results/PSL-results",
        "final_PSL double, scenario string",
        r".*pareto.*{ssp}.*\.csv$",
        r"base.*jan.*\.csv$",
        exclude="base",
        all_reference_files=True,
        rename={"final_PSL": "value"},
        constants={"Units": "PSL", "account": "PSL"},
    ),
    "population": Output("SDG0-POP/indiv_results", _LONG, "pop_{ssp}", "pop_sdgstudy_base"),
}


def _shape(rows: DataFrame, out: Output) -> DataFrame:
    if out.distinct:
        rows = rows.distinct()
    rows = rows.drop("file").withColumnsRenamed(dict(out.rename))
    for name, text in out.constants.items():
        rows = rows.withColumn(name, F.lit(text))
    return rows


def gather(spark: SparkSession, root: str, indicator: str, ssp: str) -> DataFrame:
    """All rows of one family's outputs of an indicator, read in one scan."""
    out = OUTPUTS[indicator]
    schema = StructType.fromDDL(out.columns)
    rows = scan_matching(
        spark, f"{root}/{out.folder}", out.pattern.format(ssp=ssp), schema, out.exclude, with_file=out.distinct
    )
    return _shape(rows, out)


def gather_reference(spark: SparkSession, root: str, indicator: str) -> DataFrame:
    """The baseline project's output: the first matching file, or all of them for the land indicator."""
    out = OUTPUTS[indicator]
    folder, schema = f"{root}/{out.folder}", StructType.fromDDL(out.columns)
    if out.all_reference_files:
        rows = scan_matching(spark, folder, out.reference_pattern, schema)
    else:
        rows = scan_first(spark, folder, out.reference_pattern, schema)
    return _shape(rows, out)


PSL_COLUMNS = (
    "forest_PSL double, pasture_PSL double, crop_irr_PSL double, crop_rfd_PSL double, "
    "final_PSL double, scenario string"
)


def gather_psl(spark: SparkSession, folder: str, columns: str = PSL_COLUMNS) -> DataFrame:
    """Every species-loss result in a folder, CSV or Parquet."""
    return extract_matching(spark, folder, StructType.fromDDL(columns))
