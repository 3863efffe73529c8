"""Named tables in one place, whatever stores them."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tripforge.operators.reconcile import fit_to

# Formats that keep the columns' names and types.
_FILE_FORMATS = {"parquet", "orc"}
CATALOG = "catalog"
#: Beside a file table's data, where Spark's readers pass it over: its schema, once columns were added to it.
_SCHEMA = "_schema"


@dataclass(frozen=True)
class TableStore:
    """Tables below ``location`` in format ``fmt``.

    A file format keeps each table in a folder of ``location``. ``catalog`` uses
    ``location`` as the database. Any other ``fmt`` is a connector that takes the
    qualified name in its ``table`` option; its jar comes with the cluster.
    """

    spark: SparkSession
    location: str
    fmt: str = "parquet"

    def address(self, name: str) -> str:
        separator = "/" if self.fmt in _FILE_FORMATS else "."
        return f"{self.location.rstrip('/')}{separator}{name}" if self.location else name

    def read(self, name: str) -> DataFrame:
        if self.fmt == CATALOG:
            return self.spark.table(self.address(name))
        reader = self.spark.read.format(self.fmt)
        if self.fmt in _FILE_FORMATS:
            # Files that were written before a column was added give nulls for it.
            grown = self._grown_schema(name)
            return (reader.schema(grown) if grown else reader).load(self.address(name))
        return reader.option("table", self.address(name)).load()

    def exists(self, name: str) -> bool:
        if self.fmt == CATALOG:
            return self.spark.catalog.tableExists(self.address(name))
        try:
            self.read(name)
        except AnalysisException as missing:
            if missing.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return False
            raise
        return True

    def _grown_schema(self, name: str) -> T.StructType | None:
        """The last schema noted by :meth:`append`; one small file, so that no read merges all footers."""
        try:
            notes = self.spark.read.schema("number long, schema string").json(f"{self.address(name)}/{_SCHEMA}")
        except AnalysisException as missing:
            if missing.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        last = notes.orderBy("number", ascending=False).head(1)
        return T.StructType.fromJson(json.loads(last[0]["schema"])) if last else None

    def _note_schema(self, name: str, schema: T.StructType) -> None:
        note = self.spark.createDataFrame([(len(schema), schema.json())], "number long, schema string")
        note.coalesce(1).write.mode("append").json(f"{self.address(name)}/{_SCHEMA}")

    def prepare(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` as rows of the stored table, which gets the columns that are new; ``df`` itself if there is none.

        A column that the table's type might not hold is an error, and nothing is changed. The new schema is noted
        before any row is written: readers then see nulls in it, never rows without their columns.
        """
        if not self.exists(name):
            return df
        stored = self.read(name).schema
        fitted, grown = fit_to(df, stored)
        added = grown.fields[len(stored) :]
        if added and self.fmt == CATALOG:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
            self.spark.sql(f"ALTER TABLE {self.address(name)} ADD COLUMNS ({columns})")
        elif added and self.fmt in _FILE_FORMATS:
            self._note_schema(name, grown)
        return fitted

    def append(self, df: DataFrame, name: str) -> None:
        """Add rows, and the columns that the table lacks."""
        self.write(self.prepare(df, name), name, mode="append")

    def replace_parts(self, df: DataFrame, name: str, parts: list[str]) -> None:
        """Write ``df`` in place of the partitions that it has rows of; others stay. For file formats.

        A write that is run again replaces what it wrote before.
        """
        if self.fmt not in _FILE_FORMATS:
            raise ValueError(f"partitions are replaced in file tables, not in format {self.fmt!r}")
        fitted = self.prepare(df, name)
        writer = fitted.hint("rebalance", *parts).write.format(self.fmt).mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy(*parts).save(self.address(name))

    def write(
        self,
        df: DataFrame,
        name: str,
        mode: str = "errorifexists",
        partition_by: str | None = None,
        cluster_by: tuple[str, ...] = (),
        **options: str | int,
    ) -> None:
        """Write a table, by partitions if asked; ``cluster_by`` sorts within each file.

        REBALANCE brings a partition's rows together, and AQE splits one that is large.
        """
        if partition_by:
            df = df.hint("rebalance", partition_by)
        if cluster_by:
            df = df.sortWithinPartitions(*([partition_by] if partition_by else []), *cluster_by)
        writer = df.write.format("parquet" if self.fmt == CATALOG else self.fmt)
        writer = writer.mode(mode).options(**options)
        if partition_by:
            writer = writer.partitionBy(partition_by)
        if self.fmt == CATALOG:
            writer.saveAsTable(self.address(name))
        elif self.fmt in _FILE_FORMATS:
            writer.save(self.address(name))
        else:
            writer.option("table", self.address(name)).save()

    def read_all(self, names: list[str]) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in names}

    def write_all(self, tables: dict[str, DataFrame], mode: str = "errorifexists") -> None:
        for name, df in tables.items():
            self.write(df, name, mode)
