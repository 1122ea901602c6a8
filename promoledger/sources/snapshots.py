"""Immutable table versions with a commit log.

``root/<table>/v=<commit>`` holds the rows a commit wrote for a table, either its whole content or rows
to append; a table is its latest whole content plus the appends since. ``root/commits`` is a JSON
dataset with one line per commit and table. Folders are written first and the log lines last, in one
file that appears by a rename, so several tables change together or not at all. One writer at a time:
the log does not arbitrate between two.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promoledger.sources.literal import literal

_LOG = "commit_id bigint, table_name string, kind string, schema_json string"


@dataclass(frozen=True)
class Version:
    """Folders of one table and its schema, as of a commit."""

    parts: tuple[int, ...]
    schema: T.StructType


@dataclass(frozen=True)
class Pinned:
    """Table versions as of one commit: every read of a job that uses it agrees."""

    spark: SparkSession
    root: str
    commit_id: int
    versions: dict[str, Version]

    def read(self, table: str) -> DataFrame:
        version = self.versions[table]
        return self.spark.read.schema(version.schema).parquet(*[f"{self.root}/{table}/v={p}" for p in version.parts])

    def register_views(self, prefix: str = "") -> None:
        """Make the pinned tables available to SQL as temporary views."""
        for table in self.versions:
            self.read(table).createOrReplaceTempView(f"{prefix}{table}")


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def log(self) -> DataFrame:
        """All commits; the log has one small line per commit and table."""
        return self.spark.read.schema(_LOG).json(f"{self.root}/commits")

    def pin(self, commit_id: int | None = None) -> Pinned:
        """Resolve the latest (or the given) commit once."""
        try:
            log = self.log() if commit_id is None else self.log().filter(F.col("commit_id") <= commit_id)
            whole = F.max(F.when(F.col("kind") == "whole", F.col("commit_id")))
            found = log.groupBy("table_name").agg(
                whole.alias("whole"),
                F.sort_array(F.collect_list("commit_id")).alias("ids"),
                F.max_by("schema_json", "commit_id").alias("schema_json"),
            )
            current = F.filter("ids", lambda i: i >= F.col("whole")).alias("parts")
            rows = found.select("table_name", "schema_json", current, F.array_max("ids").alias("last")).collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = []
        versions = {
            r["table_name"]: Version(tuple(r["parts"]), T.StructType.fromJson(json.loads(r["schema_json"]))) for r in rows
        }
        return Pinned(self.spark, self.root, max((r["last"] for r in rows), default=0), versions)

    def read(self, table: str) -> DataFrame:
        """The current version; two calls may see two versions, ``pin`` does not."""
        return self.pin().read(table)

    def commit(self, tables: Mapping[str, DataFrame] | None = None, append: Mapping[str, DataFrame] | None = None) -> int:
        """Replace and extend tables and make all of it visible together.

        An append writes the new rows only, whatever the size of the table. A folder left by a writer
        that died before its commit is replaced: nothing points to it.
        """
        pinned = self.pin()
        commit_id = pinned.commit_id + 1
        lines = []
        for kind, frames in (("whole", tables or {}), ("append", append or {})):
            for name, df in frames.items():
                df.write.mode("overwrite").parquet(f"{self.root}/{name}/v={commit_id}")
                stored_kind = kind if name in pinned.versions else "whole"
                lines.append((commit_id, name, stored_kind, df.schema.json()))
        literal(self.spark, lines, _LOG).coalesce(1).write.mode("append").json(f"{self.root}/commits")
        return commit_id
