"""Tables whose writes are committed by a manifest.

A write goes to a folder of its own first.  It becomes part of the table by one
small manifest file that names the folders of all finished writes; a rename of
that single file is the commit.  Readers follow the newest manifest, so a write
that was killed halfway is never seen, and an overwrite does not remove what a
reader is using.  A manifest also keeps the ids of all writes: repeating one with
the same id (a retried batch) changes nothing.

One writer at a time; a second one that started from the same manifest fails when
it commits.  Folders that no manifest names can be removed at any time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_ENTRY = "version long, write_id string, folder string, live boolean, fmt string, fields string"


def manifest(spark: SparkSession, path: str) -> list:
    """Entries of the newest manifest (one per write); none without a table."""
    try:
        rows = spark.read.schema(_ENTRY).json(f"{path}/commits/*/*.json")
        newest = rows.agg(F.max("version")).first()[0]
        return rows.filter(F.col("version") == F.lit(newest)).orderBy("folder").collect() if newest is not None else []
    except AnalysisException as ex:
        if "PATH_NOT_FOUND" in str(ex):
            return []
        raise


def write(df: DataFrame, path: str, write_id: str, mode: str = "append", fmt: str = "parquet",
          partition_by: Sequence[str] = (), allow_empty: bool = False) -> bool:
    """Append to the table or replace its rows; True if something was committed.

    False, and no change, if ``write_id`` has been committed before, or (unless
    ``allow_empty``) if there are no rows.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError("mode must be 'append' or 'overwrite'")
    spark = df.sparkSession
    old = manifest(spark, path)
    if any(r["write_id"] == write_id for r in old):
        return False
    version = max([r["version"] for r in old], default=0) + 1
    folder = f"{version:012d}-{uuid.uuid4().hex}"
    staged = f"{path}/data/{folder}"
    writer = df.write.format(fmt).partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    writer.save(staged)
    # the rows are looked at where they were written, not computed again
    if not allow_empty and _folder(spark, staged, fmt, df.schema).isEmpty():
        return False
    keep = [(version, r["write_id"], r["folder"], r["live"] and mode == "append", r["fmt"], r["fields"]) for r in old]
    entries = [*keep, (version, write_id, folder, True, fmt, df.schema.json())]
    spark.createDataFrame(entries, _ENTRY).coalesce(1).write.mode("errorifexists").json(f"{path}/commits/{version:012d}")
    return True


def _folder(spark: SparkSession, path: str, fmt: str, schema: StructType) -> DataFrame:
    reader = spark.read.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.options(header=True, escape='"', multiLine=True)
    return reader.load(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all finished writes that no overwrite has replaced, columns
    matched by name."""
    live = [r for r in manifest(spark, path) if r["live"]]
    if not live:
        raise FileNotFoundError(f"no committed write in {path}")
    out = None
    for r in live:
        one = _folder(spark, f"{path}/data/{r['folder']}", r["fmt"], StructType.fromJson(json.loads(r["fields"])))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out
