"""A model's parts kept together: written to a folder of their own, made visible by one rename.

``<path>/versions/<id>/`` holds the parts of a version, ``<path>/MANIFEST`` names the version
that counts, with its features, its further data and a digest of every file. A writer that stops
at any point leaves the former version in place; a reader sees one version, whole, or an error.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import SparkSession, functions as F

MANIFEST = "MANIFEST"


def _hadoop(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, conf, place, place.getFileSystem(conf)


def _write(spark: SparkSession, path: str, text: str) -> None:
    _, _, place, fs = _hadoop(spark, path)
    out = fs.create(place, True)
    out.write(bytearray(text.encode()))
    out.close()


def _replace(spark: SparkSession, source: str, target: str) -> None:
    """One rename that also replaces a file."""
    jvm, conf, place, _ = _hadoop(spark, source)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), conf)
    context.rename(place, jvm.org.apache.hadoop.fs.Path(target), options)


def _exists(spark: SparkSession, path: str) -> bool:
    _, _, place, fs = _hadoop(spark, path)
    return fs.exists(place)


def digest(spark: SparkSession, folder: str) -> str:
    """Of the names and contents of all data files below a folder; one row per file reaches the driver."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    name = F.regexp_extract("path", f"{folder.rstrip('/').rsplit('/', 1)[-1]}/(.*)$", 1)
    rows = files.select(name.alias("name"), F.sha2("content", 256).alias("hash")).collect()
    lines = sorted(f"{r['name']} {r['hash']}" for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def save_bundle(path: str, parts: Mapping[str, Callable[[str], None]], features: Sequence[str], meta: Mapping) -> str:
    """Writes each part with its function and commits them as one version; returns its id."""
    spark, version = SparkSession.active(), uuid.uuid4().hex
    folder = f"{path}/versions/{version}"
    for name, write in parts.items():
        write(f"{folder}/{name}")
    manifest = {"version": version, "features": list(features), "meta": dict(meta), "digest": digest(spark, folder)}
    waiting = f"{path}/{MANIFEST}.{version}"
    _write(spark, waiting, json.dumps(manifest))
    _replace(spark, waiting, f"{path}/{MANIFEST}")
    return version


def load_bundle(spark: SparkSession, path: str, features: Sequence[str] | None = None) -> tuple[str, dict]:
    """(folder of the parts, manifest) of the version that counts, after checking its files and, if given, its features."""
    if not _exists(spark, f"{path}/{MANIFEST}"):
        raise FileNotFoundError(f"no committed model in {path}")
    text = "\n".join(r["value"] for r in spark.read.text(f"{path}/{MANIFEST}").collect())
    manifest = json.loads(text)
    folder = f"{path}/versions/{manifest['version']}"
    if features is not None and list(features) != manifest["features"]:
        raise ValueError("the model was trained on other features")
    if digest(spark, folder) != manifest["digest"]:
        raise ValueError("files of the model were changed or are missing")
    return folder, manifest
