"""Outputs of a project that change as a whole.

A job writes several tables. Overwriting their folders one by one leaves a mixture of old and new behind if
the job dies in between. Here every run writes into folders of its own, which nobody reads yet; when all tables
are there, a small manifest that names them is put in place by one rename. Readers follow the latest manifest
of each project. A run that dies leaves folders that no manifest names; ``vacuum`` removes them.

Two runs of one project at a time take the same number, and the second one's rename fails: its tables are not
read by anybody, and the first one's stay.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

PROJECT = "project"


@dataclass(frozen=True)
class Manifest:
    """The tables of one run: folders by name, relative to the root."""

    project: str
    number: int
    tables: Mapping[str, str]


def _store(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _names(spark: SparkSession, folder: str) -> list[str]:
    store, path = _store(spark, folder)
    return sorted(s.getPath().getName() for s in store.listStatus(path)) if store.exists(path) else []


def _manifests(root: str, project: str) -> str:
    return f"{root}/manifests/{quote(project, safe='')}"


def latest(spark: SparkSession, root: str, project: str) -> Manifest | None:
    numbers = [n for n in _names(spark, _manifests(root, project)) if n.isdigit()]
    return _read(spark, f"{_manifests(root, project)}/{numbers[-1]}") if numbers else None


def _read(spark: SparkSession, path: str) -> Manifest:
    store, place = _store(spark, path)
    stream = store.open(place)
    try:
        data = spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)
    finally:
        stream.close()
    return Manifest(**json.loads(bytes(data)))


def all_latest(spark: SparkSession, root: str, project: str | None = None) -> list[Manifest]:
    """The manifest of each project, or of those whose name matches a regex; a few lines for each project."""
    from urllib.parse import unquote

    names = [unquote(n) for n in _names(spark, f"{root}/manifests")]
    found = [latest(spark, root, n) for n in names if project is None or re.search(project, n)]
    return [m for m in found if m]


def commit(spark: SparkSession, root: str, project: str, tables: Mapping[str, DataFrame]) -> Manifest:
    """Write all tables of a project, then let readers see them. Tables that a run doesn't name are gone with it."""
    before = latest(spark, root, project)
    number = before.number + 1 if before else 1
    run = f"versions/{quote(project, safe='')}/{number:08d}-{uuid.uuid4().hex[:12]}"
    for name, df in tables.items():
        labelled = df.withColumn(PROJECT, F.lit(project))
        labelled.write.option("nullValue", "NA").csv(f"{root}/{run}/{name}", header=True)
    manifest = Manifest(project, number, {name: f"{run}/{name}" for name in tables})
    _put(spark, f"{_manifests(root, project)}/{number:08d}", json.dumps(manifest.__dict__))
    return manifest


def _put(spark: SparkSession, path: str, text: str) -> None:
    """A file that is there as a whole or not at all."""
    store, place = _store(spark, path)
    _, draft = _store(spark, f"{place.getParent().toString()}/.{uuid.uuid4().hex}")
    stream = store.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if store.exists(place) or not store.rename(draft, place):
        store.delete(draft, False)
        raise RuntimeError(f"another run has written {path}")


def read(spark: SparkSession, root: str, name: str, schema: StructType, project: str | None = None) -> DataFrame:
    """A table of all projects, or of those whose name matches a regex, with its project, in one scan."""
    full = StructType(schema.fields + [StructField(PROJECT, StringType())])
    folders = [f"{root}/{m.tables[name]}" for m in all_latest(spark, root, project) if name in m.tables]
    if not folders:
        return spark.createDataFrame([], full)
    return spark.read.csv(folders, schema=full, header=True, nullValue="NA", enforceSchema=False)


def exists(spark: SparkSession, root: str) -> bool:
    return bool(_names(spark, f"{root}/manifests"))


def vacuum(spark: SparkSession, root: str, keep: int = 1) -> int:
    """Delete the folders that none of the last ``keep`` manifests of each project names; returns how many went.

    Not while a run of the root's projects is writing: its folders have no manifest yet.
    """
    n = 0
    for quoted in _names(spark, f"{root}/versions"):
        folder = f"{root}/manifests/{quoted}"
        numbers = [x for x in _names(spark, folder) if x.isdigit()]
        named = {t.rsplit("/", 1)[0] for x in numbers[-keep:] for t in _read(spark, f"{folder}/{x}").tables.values()}
        for run in _names(spark, f"{root}/versions/{quoted}"):
            if f"versions/{quoted}/{run}" not in named:
                store, path = _store(spark, f"{root}/versions/{quoted}/{run}")
                n += bool(store.delete(path, True))
    return n
