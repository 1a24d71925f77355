"""Runs that readers see as a whole."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from scenlens.sources import versions as V

SCHEMA = StructType([StructField("scenario", StringType()), StructField("value", DoubleType())])


def table(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def seen(spark, root, project=None):
    return {n: sorted(map(str, map(tuple, V.read(spark, root, n, SCHEMA, project).collect()))) for n in ("a", "b")}


def test_a_run_that_dies_between_two_tables_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    V.commit(spark, root, "p 1/é", {"a": table(spark, ("s", 1.0)), "b": table(spark, ("s", None))})
    V.commit(spark, root, "other", {"a": table(spark, ("t", 5.0))})
    old = seen(spark, root)
    assert old == {"a": ["('s', 1.0, 'p 1/é')", "('t', 5.0, 'other')"], "b": ["('s', None, 'p 1/é')"]}
    dies = table(spark, ("s", 3.0)).withColumn("value", F.raise_error(F.lit("the executor is lost")).cast("double"))
    with pytest.raises(Exception, match="the executor is lost"):
        V.commit(spark, root, "p 1/é", {"a": table(spark, ("s", 2.0)), "b": dies})
    assert len(list((tmp_path / "versions").glob("*/*/a"))) == 3  # the first table of the dead run is there
    assert seen(spark, root) == old and V.latest(spark, root, "p 1/é").number == 1
    assert V.vacuum(spark, root) == 1 and seen(spark, root) == old
    V.commit(spark, root, "p 1/é", {"a": table(spark, ("s", 2.0)), "b": table(spark, ("s", 7.0))})
    assert seen(spark, root, "^p") == {"a": ["('s', 2.0, 'p 1/é')"], "b": ["('s', 7.0, 'p 1/é')"]}
    assert V.vacuum(spark, root, keep=2) == 0 and V.vacuum(spark, root) == 1


def test_a_second_run_at_the_same_time_fails(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    V.commit(spark, root, "p", {"a": table(spark, ("s", 1.0))})
    first = V.latest(spark, root, "p")
    V.commit(spark, root, "p", {"a": table(spark, ("s", 2.0))})
    monkeypatch.setattr(V, "latest", lambda *_: first)  # what a run saw that began before
    with pytest.raises(RuntimeError, match="another run"):
        V.commit(spark, root, "p", {"a": table(spark, ("s", 3.0))})
    monkeypatch.undo()
    assert seen(spark, root)["a"] == ["('s', 2.0, 'p')"] and not [f for f in (tmp_path / "manifests" / "p").iterdir() if len(f.name) > 30]


def test_nothing_written(spark, tmp_path):
    assert not V.exists(spark, str(tmp_path)) and seen(spark, str(tmp_path)) == {"a": [], "b": []}
    assert V.latest(spark, str(tmp_path), "p") is None and V.vacuum(spark, str(tmp_path)) == 0
