"""Readers, writers, cached tables, and descriptions of tables."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tidegrid.functions.nulls import nan_to_null
from tidegrid.sources.schemas import SCHEMAS, logical_type


def read_table(spark: SparkSession, path: str, name: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """A table by its path's ending (csv, json, orc, else Parquet), with the schema of the table ``name`` if one is given.

    ``columns`` reach the reader as a projection.  NaN becomes null."""
    schema = SCHEMAS.get(name) if name else None
    ending = path.rstrip("/").rpartition(".")[2].lower()
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if ending == "csv":
        df = reader.option("header", True).csv(path)
    elif ending == "json":
        df = reader.option("multiLine", True).json(path)
    elif ending == "orc":
        df = reader.orc(path)
    else:
        df = reader.parquet(path)
    return nan_to_null(df.select(*columns) if columns else df)


def read_any(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table ``name`` of a folder, Parquet or else CSV with the schema of that name."""
    try:
        return read_table(spark, f"{folder}/{name}.parquet")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    return read_table(spark, f"{folder}/{name}.csv", name)


def write_table(df: DataFrame, path: str, partition: list[str] | None = None, single: bool = False) -> None:
    """To the format of the path's ending.  ``single`` puts a small table in one file."""
    ending = path.rstrip("/").rpartition(".")[2].lower()
    writer = (df.coalesce(1) if single else df).write.mode("overwrite")
    if partition:
        writer = writer.partitionBy(*partition)
    if ending == "csv":
        writer.option("header", True).csv(path)
    elif ending == "json":
        writer.json(path)
    elif ending == "orc":
        writer.orc(path)
    else:
        writer.parquet(path)


def cached(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The Parquet table at ``path``, built and written if it isn't there."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    write_table(build(), path)
    return spark.read.parquet(path)


def present(df: DataFrame, manifest: DataFrame, key: str) -> DataFrame:
    """Rows whose key a manifest lists."""
    return df.join(manifest.select(key).distinct(), key, "left_semi")


def rate(column: str):
    """A frame rate that is written as a fraction, as a number."""
    parts = F.split(F.col(column), "/")
    return parts[0].cast("double") / F.coalesce(F.get(parts, F.lit(1)).cast("double"), F.lit(1.0))


def checksums(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Path, bytes and SHA-256 of the files in a folder, read by executors."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def mismatches(found: DataFrame, registry: DataFrame, key: str, sha: str = "sha256") -> DataFrame:
    """Files that the registry doesn't have or has with another checksum, and entries without a file."""
    r = registry.select(key, F.col(sha).alias("_expected"))
    both = found.join(r, key, "full_outer")
    return both.where(~F.col(sha).eqNullSafe(F.col("_expected"))).select(key, F.col(sha).alias("found"), F.col("_expected").alias("expected"))


def profile(df: DataFrame) -> DataFrame:
    """One row for each column: rows, nulls, and distinct values (estimated), in one pass."""
    names = df.columns
    every = df.agg(F.count(F.lit(1)).alias("rows"), *(F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(f"n{k}") for k, c in enumerate(names)), *(F.approx_count_distinct(F.col(f"`{c}`")).alias(f"d{k}") for k, c in enumerate(names)))
    items = F.array(*(F.struct(F.lit(c).alias("column"), F.lit(logical_type(df.schema[c].dataType)).alias("type"), F.col("rows"), F.col(f"n{k}").alias("nulls"), F.col(f"d{k}").alias("distinct")) for k, c in enumerate(names)))
    return every.select(F.explode(items).alias("r")).select("r.*")


def describe(df: DataFrame, name: str, path: str, text: str, schema: T.StructType | None = None, files: DataFrame | None = None) -> dict:
    """A resource of a data package.  A column without a description is an error."""
    known = {f.name: f.metadata for f in (schema or SCHEMAS.get(name) or df.schema).fields}
    fields = []
    for f in df.schema.fields:
        about = known.get(f.name, {})
        if not about.get("description"):
            raise ValueError(f"{path}: no description for column {f.name}")
        field = {"name": f.name, "type": logical_type(f.dataType), "description": about["description"]}
        if about.get("unit"):
            field["unit"] = about["unit"]
        fields.append(field)
    ending = path.rpartition(".")[2]
    out = {"name": name, "path": path, "description": text, "format": ending, "mediatype": "text/csv" if ending == "csv" else "application/vnd.apache.parquet", "rows": df.count(), "schema": {"fields": fields}}
    if files is not None:
        parts = files.orderBy("path").collect()  # a table's file list
        out |= {"bytes": sum(p.bytes for p in parts), "hash": ["sha256:" + p.sha256 for p in parts]}
    return out


def package(name: str, version: str, resources: list[dict]) -> str:
    return json.dumps({"name": name, "version": version, "created": date.today().isoformat(), "resources": resources}, indent=2) + "\n"
