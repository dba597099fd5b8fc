"""JDBC scans."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

_QUERY_TEXT = re.compile(r"\s*(select|with)\b", re.IGNORECASE)


def jdbc_options(
    url: str,
    table_or_query: str,
    driver: str,
    user: str | None = None,
    password: str | None = None,
    extra_options: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | str | None = None,
    upper_bound: int | str | None = None,
    num_partitions: int = 4,
) -> dict[str, str]:
    """Reader options for one JDBC scan.

    A query is passed as an aliased subquery in ``dbtable``, because the reader's
    ``query`` option rules out a partitioned read.
    """
    relation = table_or_query
    if _QUERY_TEXT.match(table_or_query):
        relation = f"({table_or_query.strip().rstrip(';')}) AS src"
    options = {"url": url, "dbtable": relation, "driver": driver}
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    options.update(extra_options or {})

    if partition_column is not None:
        if lower_bound is None or upper_bound is None:
            raise ValueError("a partitioned JDBC read needs lower_bound and upper_bound")
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    return options


def read_jdbc(spark: SparkSession, url: str, table_or_query: str, driver: str, **settings) -> DataFrame:
    """Scan a table or the result of a query; ``settings`` as in :func:`jdbc_options`.

    The bounds only set the stride of the partitions: rows outside them are read
    too, by the first and last partition. Without ``partition_column`` the whole
    result comes through one task, so give one for any large table.
    """
    return spark.read.format("jdbc").options(**jdbc_options(url, table_or_query, driver, **settings)).load()
