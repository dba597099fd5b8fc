"""Column and table names, resolved the way the session resolves them."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession


def quoted(name: str) -> str:
    """A column name as an expression; dots and backticks in it are kept."""
    return "`" + name.replace("`", "``") + "`"


def name_key(spark: SparkSession) -> Callable[[str], str]:
    """The function under which two column names count as the same one."""
    if spark.conf.get("spark.sql.caseSensitive", "false").lower() == "true":
        return lambda name: name
    return str.lower


class Columns:
    """The column names of a frame, with look-up by the session's rule."""

    def __init__(self, df: DataFrame):
        self.names = list(df.columns)
        self.key = name_key(df.sparkSession)
        self._by_key = {self.key(c): c for c in self.names}

    def find(self, name: str) -> str | None:
        """The frame's own spelling of ``name``, or None when it has no such column."""
        return self._by_key.get(self.key(name))

    def require(self, names: Iterable[str]) -> list[str]:
        """The frame's spelling of every name; a missing one raises."""
        found = [self.find(name) for name in names]
        if None in found:
            raise ValueError(f"not every one of {list(names)} is among the columns {self.names}")
        return found


def is_path(target: str) -> bool:
    """Whether a target names a directory rather than a catalog table."""
    return "/" in target


def qualified_name(spark: SparkSession, table: str) -> str:
    """A bare table name gets the current catalog and database; a dotted one is kept."""
    if "." in table:
        return table
    return f"{spark.catalog.currentCatalog()}.{spark.catalog.currentDatabase()}.{table}"


def quoted_table(name: str) -> str:
    return ".".join(quoted(part.strip("`")) for part in name.split("."))
