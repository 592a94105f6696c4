"""External tables over files (K5, K6, Q1, Q2)."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from strandline.sources.files import glob_of


def quoted(parts: Sequence[str]) -> str:
    """A name for use inside SQL text, each part in backticks."""
    return ".".join("`" + part.strip("`").replace("`", "``") + "`" for part in parts)


def ensure_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a database unless it exists (K6)."""
    if spark.catalog.databaseExists(name):
        return
    text = "CREATE DATABASE IF NOT EXISTS IDENTIFIER(:name)"
    if location:
        text += f" LOCATION {_literal(location)}"
    spark.sql(text, args={"name": name})


def register_external(spark: SparkSession, table: str, path: str, depth: int = 0) -> DataFrame:
    """Create or redefine an external table over the Parquet files of a location (K5, Q2).

    The schema comes from the file footers. The old definition must be that of an external table, whose files
    stay as they are. A managed table or a view of that name raises, since dropping it would lose what it holds.

    Where the new files have the old columns, and maybe more, the table is altered and never absent: readers see the old files or
    the new ones. Where columns are gone or of another type Spark has no such change, and the table is dropped and created:
    :func:`register_versioned` swaps those as well.
    """
    files = glob_of(path, depth)
    if not spark.catalog.tableExists(table):
        return spark.catalog.createTable(table, path=files, source="parquet")
    kind = spark.catalog.getTable(table).tableType
    if kind != "EXTERNAL":
        raise ValueError(f"{table} is not an external table but {kind}")
    old = {field.name: field.dataType for field in spark.table(table).schema}
    new = {field.name: field.dataType for field in spark.read.parquet(files).schema}
    if any(new.get(name) != kind for name, kind in old.items()):
        spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:table)", args={"table": table})
        return spark.catalog.createTable(table, path=files, source="parquet")
    name = quoted(_parts_of(table))
    added = ", ".join(f"{quoted([column])} {kind.simpleString()}" for column, kind in new.items() if column not in old)
    if added:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({added})")
    spark.sql(f"ALTER TABLE {name} SET LOCATION {_literal(files)}")
    spark.catalog.refreshTable(table)
    return spark.table(table)


def register_versioned(spark: SparkSession, name: str, path: str, depth: int = 0) -> DataFrame:
    """Create or redefine a table over files of any columns without a moment in which it is absent (K5, Q2).

    ``name`` is a view over an external table of its own for each definition; replacing the view is one step of the catalog. The table of
    the definition before goes afterwards, its files stay. A table of that name raises.
    """
    parts = _parts_of(name)
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        raise ValueError(f"{name} is not a view")
    stem = f"{parts[-1]}__"
    space = [quoted(parts[:-1])] if parts[:-1] else []
    before = [t.name for t in spark.catalog.listTables(*space) if t.name.startswith(stem) and t.tableType == "EXTERNAL"]
    own = [*parts[:-1], f"{stem}{uuid.uuid4().hex}"]
    spark.catalog.createTable(quoted(own), path=glob_of(path, depth), source="parquet")
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(parts)} AS SELECT * FROM {quoted(own)}")
    for old in before:
        spark.sql(f"DROP TABLE IF EXISTS {quoted([*parts[:-1], old])}")
    return spark.table(name)


def _parts_of(name: str) -> list[str]:
    """The parts of a name, which may be in backticks."""
    return [part.strip("`").replace("``", "`") for part in re.findall(r"`(?:[^`]|``)*`|[^.`]+", name)]


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def register_view(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """Create or redefine a session view, e.g. over the union of the two silver parts (K5, Q2)."""
    df.createOrReplaceTempView(name)
    return spark.table(name)


def register_union(spark: SparkSession, name: str, tables: Sequence[str]) -> DataFrame:
    """Create or redefine a catalog view over all rows of some tables, e.g. the two silver parts."""
    # Names can not be parameters inside a view's text, so let the catalog confirm each one first.
    for table in tables:
        if not spark.catalog.tableExists(table):
            raise ValueError(f"no table {table}")
    columns = ", ".join(map(quoted, ([c] for c in spark.table(tables[0]).columns)))
    parts = " UNION ALL ".join(f"SELECT {columns} FROM {quoted(table.split('.'))}" for table in tables)
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(name.split('.'))} AS {parts}")
    return spark.table(name)


def run_sql(spark: SparkSession, text: str, refresh: Sequence[str] = (), **args) -> DataFrame:
    """Any SQL over registered tables, values as named parameters (Q1, L1).

    Spark remembers the files of an external table. Name the tables to ``refresh`` to see files that came
    after their last use.
    """
    for table in refresh:
        spark.catalog.refreshTable(table)
    return spark.sql(text, args=args or None)
