"""Databases, tables and partitions in Spark's catalog."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidewire.schema import PARTITIONS, table_schema


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(spark: SparkSession, name: str, location: str | None = None, comment: str = "") -> None:
    where = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quote(name)} COMMENT {_text(comment)}{where}")


def create_table(spark: SparkSession, database: str, table: str, location: str, name: str | None = None) -> None:
    """An external partitioned Parquet table with the declared columns."""
    columns = ", ".join(f"{_quote(f.name)} {f.dataType.simpleString()}" for f in table_schema(table).fields)
    parts = ", ".join(map(_quote, PARTITIONS[table]))
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_quote(database)}.{_quote(name or table)} ({columns}) USING parquet PARTITIONED BY ({parts}) LOCATION {_text(location)}")


def _spec(values: dict) -> str:
    return ", ".join(f"{_quote(k)}={v if isinstance(v, int) else _text(str(v))}" for k, v in values.items())


def add_partition(spark: SparkSession, table: str, values: dict, location: str) -> None:
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({_spec(values)}) LOCATION {_text(location)}")


def add_partitions(spark: SparkSession, table: str, places: list[tuple[dict, str]]) -> None:
    """Add several partitions, each with its values and location, in one statement."""
    if places:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(f"PARTITION ({_spec(v)}) LOCATION {_text(at)}" for v, at in places))


def refresh(spark: SparkSession, table: str) -> None:
    spark.sql(f"REFRESH TABLE {table}")


def compute_stats(spark: SparkSession, table: str, values: dict) -> None:
    spark.sql(f"ANALYZE TABLE {table} PARTITION ({_spec(values)}) COMPUTE STATISTICS")


def upgrade(spark: SparkSession, table: str, kind: str) -> list[str]:
    """Add declared columns that a stored table lacks; returns their names. Running it again changes nothing."""
    have = {c.lower() for c in spark.table(table).columns}
    new = [f for f in table_schema(kind).fields if f.name not in have]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'{_quote(f.name)} {f.dataType.simpleString()}' for f in new)})")
    return [f.name for f in new]


def run_statements(spark: SparkSession, script: str) -> list[tuple[str, bool]]:
    """Run an upgrade script, one statement a line, ``#`` lines left out; a failing statement does not stop the others."""
    out = []
    for line in script.splitlines():
        statement = line.strip().rstrip(";")
        if not statement or statement.startswith("#"):
            continue
        try:
            spark.sql(statement)
            out.append((statement, True))
        except Exception:
            out.append((statement, False))
    return out
