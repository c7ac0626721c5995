"""Writing layer tables: immutable versions behind a view that one statement switches.

Each write makes a new version, a table of its own; readers go through a view of the table's
name. When the version is complete, one ``CREATE OR REPLACE VIEW`` moves the view to it,
together with its comment, its properties and its column comments, so a reader in any session
sees the old version or the new one and never a missing table. A write that fails or stops
before that statement leaves the view as it was. The version that the view left stays for
readers that are still at it; older ones, and those of failed writes, are dropped after the
switch. Storage holds two versions and the one that is being written. One writer a table at a
time. ``patch`` replaces the rows of some keys: only these are written, and the same statement
makes the view the older parts without those keys, and the new part. The row count comes from an ``Observation`` on the write itself, not from a second scan.
"""

from __future__ import annotations

import os
import time
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Between a table's name and its version's number; prefix of the view's own properties, and the one that names the versions.
VERSION_MARK = "__v"
OWN = "traveltiers."
VERSION_KEY = OWN + "version"
#: A view of so many parts is written as one by the next patch.
MAX_PARTS = 16


def _quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def outside(key: str, values: list) -> str:
    """SQL condition: ``key`` is none of ``values`` (dates, integers or strings; None stands for NULL)."""
    known = [f"DATE '{v}'" if isinstance(v, date) else str(v) if isinstance(v, int) else _quote(v) for v in values if v is not None]
    rest = f"`{key}` NOT IN ({', '.join(known)})" if known else "true"
    return f"`{key}` IS NOT NULL AND {rest}" if None in values else f"(`{key}` IS NULL OR {rest})"


@dataclass
class TableSink:
    spark: SparkSession
    database: str = "traveltiers"
    root: str | None = None
    database_comment: str = "Tiered travel analytics: raw, cleaned and aggregated tables with quality checks"
    written: dict[str, int] = field(default_factory=dict)
    observed: dict[str, dict] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.root is None:
            # Results never go under the checkpoint folder: that is scratch space of one application.
            warehouse = self.spark.conf.get("spark.sql.warehouse.dir")
            self.root = os.path.join(warehouse, f"{self.database.replace('.', '/')}_tables")
        self.spark.sql(
            f"CREATE SCHEMA IF NOT EXISTS {self._schema()} COMMENT {_quote(self.database_comment)} "
            f"LOCATION {_quote(self.root)}"
        )

    def _schema(self) -> str:
        """The target schema, ``schema`` or ``catalog.schema``, quoted part by part."""
        return ".".join(f"`{part}`" for part in self.database.split("."))

    def name(self, table: str) -> str:
        return f"{self._schema()}.`{table}`"

    def write(
        self,
        df: DataFrame,
        table: str,
        comment: str | None = None,
        properties: dict[str, str] | None = None,
        column_comments: dict[str, str] | None = None,
        partition_by: list[str] | None = None,
        observe: dict[str, Column] | None = None,
    ) -> int:
        """Overwrite ``table`` with ``df``; returns the number of rows written.

        ``observe`` adds named aggregate metrics computed during the same write
        (no second scan); they are kept in ``self.observed[table]``.
        """
        before = self.versions(table)
        version, metrics = self._save(df, table, partition_by, observe)
        self._switch(table, [version], self._select(df.columns, self.name(version)), df.columns, comment, properties, column_comments)
        return self._done(table, {version, *before}, metrics)

    def patch(
        self,
        df: DataFrame,
        table: str,
        key: str,
        values: list,
        comment: str | None = None,
        properties: dict[str, str] | None = None,
        column_comments: dict[str, str] | None = None,
        observe: dict[str, Column] | None = None,
    ) -> int:
        """Replace the rows whose ``key`` is one of ``values`` (None: NULL) by ``df``, which is all that is
        written; returns its number of rows. Rows of ``df`` with other keys are an error.

        ``values`` stand in the view's text: a list of bounded size, such as days. A table of
        MAX_PARTS parts is written whole instead, with the same rows.
        """
        before = self.versions(table)
        if not before:
            raise ValueError(f"no table {table} to patch")
        columns = self.read(table).columns
        inside = f"NOT ({outside(key, values)})"
        df = df.select(*columns).withColumn(key, F.when(F.expr(inside), F.col(key)).otherwise(F.raise_error(F.lit(f"{table}: a row beyond the patch's keys"))))
        if len(before) >= MAX_PARTS:
            rest = self.read(table).where(outside(key, values))
            return self.write(rest.unionByName(df), table, comment, properties, column_comments, None, observe)
        version, metrics = self._save(df, table, None, observe)
        query = (f"{self._select(columns, '(' + self._told(table, 'View Text') + ')')} WHERE {outside(key, values)} "
                 f"UNION ALL {self._select(columns, self.name(version))}")
        self._switch(table, [*before, version], query, columns, comment, properties, column_comments)
        return self._done(table, {version, *before}, metrics)

    def _save(self, df: DataFrame, table: str, partition_by: list[str] | None, observe: dict[str, Column] | None) -> tuple[str, dict]:
        """``df`` as a new version, which nothing shows yet, and what was observed in the write."""
        obs = Observation(f"rows_{table}")
        df = df.observe(obs, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (observe or {}).items()])
        version = f"{table}{VERSION_MARK}{time.time_ns():020d}"
        if partition_by:
            # Files of the advisory size for each partition value: small ones are joined, a hot one is split (AQE).
            df = df.hint("rebalance", *partition_by)
        w = df.write.format("parquet")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.saveAsTable(self.name(version))
        return version, dict(obs.get)

    def _done(self, table: str, keep: set[str], metrics: dict) -> int:
        self._drop_versions(table, keep)
        self.written[table] = int(metrics["rows"])
        self.observed[table] = metrics
        return self.written[table]

    @staticmethod
    def _select(columns: list[str], source: str) -> str:
        return f"SELECT {', '.join(f'`{c}`' for c in columns)} FROM {source}"

    def _switch(self, table: str, versions: list[str], query: str, columns: list[str], comment: str | None,
                properties: dict[str, str] | None, column_comments: dict[str, str] | None) -> None:
        """The one statement that makes ``query`` over ``versions`` the table, with all its metadata."""
        said = column_comments or {}
        named = ", ".join(f"`{c}`" + (f" COMMENT {_quote(said[c])}" if c in said else "") for c in columns)
        listed = ", ".join(f"{_quote(k)} = {_quote(v)}" for k, v in {**(properties or {}), VERSION_KEY: ",".join(versions)}.items())
        told = f" COMMENT {_quote(comment)}" if comment else ""
        if self._kind(table) not in (None, "VIEW"):  # a table of an older layout, once
            self.spark.sql(f"DROP TABLE {self.name(table)}")
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(table)} ({named}){told} TBLPROPERTIES ({listed}) "
                       f"AS {query}")

    def _drop_versions(self, table: str, keep: set[str]) -> None:
        rows = self.spark.sql(f"SHOW TABLES IN {self._schema()} LIKE {_quote(table + VERSION_MARK + '*')}").collect()
        for name in sorted(r.tableName for r in rows):
            if name not in keep:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.name(name)}")

    def _told(self, table: str, what: str) -> str | None:
        """One line of the table's extended description, or None when there is nothing of that name."""
        if not self.spark.catalog.tableExists(f"{self.database}.{table}"):
            return None
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(table)}").collect()
        return next((r.data_type for r in rows if r.col_name == what), None)

    def _kind(self, table: str) -> str | None:
        """VIEW, MANAGED, EXTERNAL, or None when there is nothing of that name."""
        return self._told(table, "Type")

    def own_property(self, table: str, key: str) -> str | None:
        """One property of the table's view, or None."""
        if self._kind(table) != "VIEW":
            return None
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").collect()
        return next((r.value for r in rows if r.key == key), None)

    def versions(self, table: str) -> list[str]:
        """The versions that the table's view shows, the oldest first; none when there is no such view."""
        said = self.own_property(table, VERSION_KEY)
        return said.split(",") if said else []

    def version(self, table: str) -> str | None:
        """The newest version that the table's view shows, or None when there is no such view."""
        return (self.versions(table) or [None])[-1]

    def location(self, table: str) -> str | None:
        """Storage location of the table's newest version, or None when it does not exist."""
        version = self.version(table)
        return version and self._told(version, "Location")

    def read(self, table: str) -> DataFrame:
        """The table's current version. The view is resolved once, so one run works on one version."""
        return self.spark.table(self.name(table))

    def properties(self, table: str) -> DataFrame:
        """The table's own properties, without those that Spark keeps for a view."""
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}")
        return rows.filter(~F.col("key").startswith("view.") & ~F.col("key").startswith(OWN) & ~F.col("key").startswith("transient"))

    def table_comment(self, table: str) -> DataFrame:
        """``(table, comment)``."""
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(table)}").filter(F.col("col_name") == "Comment")
        return rows.select(F.lit(table).alias("table"), F.col("data_type").alias("comment"))

    def schema_comment(self) -> DataFrame:
        """``(schema, comment)``."""
        rows = self.spark.sql(f"DESCRIBE SCHEMA EXTENDED {self._schema()}").filter(F.col("info_name") == "Comment")
        return rows.select(F.lit(self.database).alias("schema"), F.col("info_value").alias("comment"))

    def column_comments(self, table: str) -> DataFrame:
        rows = self.spark.sql(f"DESCRIBE TABLE {self.name(table)}")
        return rows.filter(F.col("comment").isNotNull() & ~F.col("col_name").startswith("#"))
