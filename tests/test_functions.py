import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from scenlens.functions import aggregates as A
from scenlens.functions import scalars as S
from scenlens.functions.fixed_values import GASES, SECTOR_PRECEDENCE_LEGACY_LAND


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "text,number", [("resid heating_d10", 10.0), ("Group7", 7.0), ("d1.5", 1.5), ("none", None), ("", None)]
)
def test_parse_number(spark, text, number):
    assert one(spark, S.parse_number("c"), c=text) == number


def test_single_number(spark):
    assert one(spark, S.single_number("c"), c="study_trn20") == 20.0
    for bad in ("study_trn", "v7_study_trn20"):
        with pytest.raises(PySparkException, match="exactly one number"):
            one(spark, S.single_number("c"), c=bad)


@pytest.mark.parametrize(
    "name,sector",
    [
        ("x_afolu5", "afolu"), ("x_indbld", "bld"), ("x_trn_dac", "dac"), ("x_dac_sup", "sup"),
        ("x", "a"), ("windy", "ind"),
    ],
)
def test_sector_of(spark, name, sector):
    assert one(spark, S.sector_of("c"), c=name) == sector


def test_sector_order_is_a_parameter(spark):
    assert one(spark, S.sector_of("c", SECTOR_PRECEDENCE_LEGACY_LAND), c="dac_sup") == "dac"


def test_splits(spark):
    assert one(spark, S.split_first("c"), c="Rice,Asia,x") == "Rice"
    assert one(spark, F.array(*S.split_padded("c", "_", 4)), c="Corn_Nile") == ["Corn", "Nile", None, None]
    assert one(spark, F.array(*S.split_padded("c", "_", 4)), c="a_b_c_d_e") == ["a", "b", "c", "d"]
    assert one(spark, F.array(*S.split_last("c")), c="study_trn20_SSP2") == ["study_trn20", "SSP2"]
    assert one(spark, F.array(*S.split_last("c")), c="study") == ["study", None]
    assert one(spark, F.array(*S.split_last("c")), c="study_") == ["study", ""]


@pytest.mark.parametrize(
    "parts,name",
    [(("Corn", None, None), "Corn"), (("Corn", "IRR", "hi"), "CornIRRhi"), (("Corn", "RFD", None), "CornRFDNA")],
)
def test_land_class(spark, parts, name):
    cols = [F.lit(p).cast("string") for p in parts]
    assert one(spark, S.land_class(*cols)) == name


def test_ratios_and_money(spark):
    assert one(spark, S.pct("a", "b"), a=1.0, b=4.0) == 25.0
    assert one(spark, S.pct("a", "b"), a=1.0, b=0.0) is None
    assert one(spark, S.diff("a", "b"), a=3.0, b=2.0) == 1.0
    assert one(spark, S.diff("a", "b", relative=True), a=3.0, b=2.0) == 0.5
    assert S.deflator({1975: 30.0, 1990: 60.0}, 1990, 1975) == 2.0
    assert one(spark, S.deflate("a", 2.0), a=3.0) == 6.0


def test_names(spark):
    assert one(spark, S.project_name("c"), c="database_basexdb_SSP1_x.dat") == "SSP1_x"
    assert one(spark, S.project_db_name("c", F.lit("ssp2")), c="x") == "database_basexdb_SSP2_x"
    assert one(spark, S.project_db_name("c", F.lit("base")), c="x") == "database_basexdb_x_base"


def test_strict_aggregates(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 1.0), ("a", None, 1.0), ("b", 1.0, 1.0), ("b", 3.0, 3.0), ("c", 1.0, 0.0)],
        "k string, x double, w double",
    )
    rows = df.groupBy("k").agg(
        A.sum_strict("x").alias("s"), A.mean_strict("x").alias("m"),
        A.weighted_mean_of("x", "w").alias("wm"), A.weighted_sum_of("x", "w").alias("ws"),
        A.ratio_of_sums_of("x", "w").alias("r"),
    )
    got = {r.k: tuple(r)[1:] for r in rows.collect()}
    assert got == {
        "a": (None, None, None, None, None),
        "b": (4.0, 2.0, 2.5, 10.0, 1.0),
        "c": (1.0, 1.0, None, 0.0, None),
    }


def test_single_fails_on_a_second_row(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0)], "k string, x double")
    with pytest.raises(PySparkException, match="more than one row"):
        df.groupBy("k").agg(A.single("x")).collect()


def test_half_even_rounding(spark):
    assert [one(spark, F.bround("x", 0), x=v) for v in (0.5, 1.5, 2.5)] == [0.0, 2.0, 2.0]


def test_gases_are_distinct():
    assert len(GASES) == len(set(GASES)) == 47
