"""Relational sources and sink over Spark's JDBC data source.

The database driver jar is the user's. Reads are split over executors by key range or by given
predicates; the high-water-mark filter is a pushed-down predicate, so no ORDER BY is needed.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from datetime import date, datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ordering import hwm_filter
from .identifiers import check_identifier

# URL shapes and driver classes of the supported databases.
URLS = {
    "sqlserver": "jdbc:sqlserver://{host}:{port};databaseName={database}",
    "postgres": "jdbc:postgresql://{host}:{port}/{database}",
    "mysql": "jdbc:mysql://{host}:{port}/{database}",
    "oracle": "jdbc:oracle:thin:@//{host}:{port}/{database}",
    "sqlite": "jdbc:sqlite:{path}",
}
PORTS = {"sqlserver": 1433, "postgres": 5432, "mysql": 3306, "oracle": 1521}
DRIVERS = {
    "sqlserver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "postgres": "org.postgresql.Driver",
    "mysql": "com.mysql.cj.jdbc.Driver",
    "oracle": "oracle.jdbc.OracleDriver",
    "sqlite": "org.sqlite.JDBC",
}


def jdbc_url(kind: str, source: Mapping[str, Any]) -> str:
    for given in ("url", "conn_str", "dsn"):
        if source.get(given):
            return _as_url(kind, str(source[given]))
    if kind not in URLS:
        raise ValueError(f"unknown database type {kind!r}")
    parts = {"host": "localhost", "port": PORTS.get(kind), **source}
    parts.setdefault("database", source.get("dbname"))
    needed = "path" if kind == "sqlite" else "database"
    if not parts.get(needed):
        raise ValueError(f"source.{needed} is required for {kind}")
    return URLS[kind].format(**parts)


def _as_url(kind: str, text: str) -> str:
    """A JDBC URL from one, from a URL of another client, or from the part behind `jdbc:<kind>:`."""
    if text.startswith("jdbc:"):
        return text
    stem = URLS[kind].split("{")[0] if kind in URLS else "jdbc:"
    return stem + (text.split("://", 1)[1] if "://" in text else text)


def _password(source: Mapping[str, Any]) -> str | None:
    """The password itself, or that of the environment variable `password_env` names."""
    if source.get("password") or not source.get("password_env"):
        return source.get("password")
    name = str(source["password_env"])
    if name not in os.environ:
        raise ValueError(f"environment variable {name!r} of source.password_env is not set")
    return os.environ[name]


def jdbc_options(kind: str, source: Mapping[str, Any]) -> dict[str, str]:
    """Connection options; a set fetch size keeps the cursor streaming on the server side."""
    options = {
        "url": jdbc_url(kind, source),
        "fetchsize": str(source.get("fetchsize", 10000)),
        # times without zone stay so, as in RAW
        "preferTimestampNTZ": "true",
    }
    if kind in DRIVERS:
        options["driver"] = source.get("driver", DRIVERS[kind])
    if kind == "mysql":
        # the driver streams only with cursor fetch on; without it a table is buffered whole
        options["useCursorFetch"] = "true"
    if kind == "sqlite" and source.get("path") and not os.path.isfile(source["path"]):
        # the driver would create an empty database
        raise FileNotFoundError(source["path"])
    for name, value in (("user", source.get("user")), ("password", _password(source))):
        if value:
            options[name] = str(value)
    options.update({k: str(v) for k, v in source.get("options", {}).items()})
    return options


def text_ranges(column: str, cuts: Sequence[str]) -> list[str]:
    """Predicates that split a text key at the given values.

    A row's part is the number of the first cut it lies below, so the parts are complete and do not
    overlap under any collation, also one that sorts otherwise than Python.
    """
    check_identifier("column", column)
    cuts = sorted(set(cuts))
    quoted = ["'" + c.replace("'", "''") + "'" for c in cuts]
    if not quoted:
        return ["1 = 1"]
    cases = " ".join(f"WHEN {column} < {cut} THEN {i}" for i, cut in enumerate(quoted))
    part = f"CASE WHEN {column} IS NULL THEN 0 {cases} ELSE {len(quoted)} END"
    return [f"({part}) = {i}" for i in range(len(quoted) + 1)]


def oracle_since(table: str, hwm: str, since: datetime | date) -> str:
    """A subquery with a time mark's predicate: the dialect writes a zone-less time without quotes."""
    check_identifier("table", table)
    check_identifier("hwm_column", hwm)
    text = since.isoformat(sep=" ") if isinstance(since, datetime) else f"{since.isoformat()} 00:00:00"
    form = "YYYY-MM-DD HH24:MI:SS" + (".FF6" if "." in text else "")
    return f"(SELECT * FROM {table} WHERE {hwm} > TO_TIMESTAMP('{text}', '{form}')) pending"


def read_jdbc(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    hwm: str,
    since: Any = None,
    partition_column: str | None = None,
    num_partitions: int = 8,
    cuts: Sequence[str] = (),
) -> DataFrame:
    """Incremental scan, split by `partition_column`, else by the mark where that is a number or a time:
    bounds come from one min/max query of the pending rows. Text key: pass the `cuts` to split at; a text
    mark without them is read by one task."""
    check_identifier("table", table)
    check_identifier("hwm_column", hwm)

    if options.get("url", "").startswith("jdbc:oracle:") and isinstance(since, date):
        table, since = oracle_since(table, hwm, since), None

    def reader():
        return spark.read.format("jdbc").options(**options)

    if cuts:
        props = {k: v for k, v in options.items() if k != "url"}
        df = spark.read.jdbc(options["url"], table, predicates=text_ranges(partition_column or hwm, cuts), properties=props)
        return hwm_filter(df, hwm, since)
    whole = reader().option("dbtable", table).load()
    if not partition_column and isinstance(whole.schema[hwm].dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        partition_column = hwm
    if not partition_column or num_partitions <= 1:
        return hwm_filter(whole, hwm, since)
    check_identifier("partition column", partition_column)
    low, high = (
        hwm_filter(whole, hwm, since)
        .agg(F.min(partition_column).cast("string"), F.max(partition_column).cast("string"))
        .first()
    )
    if low is None:
        return hwm_filter(whole, hwm, since)
    split = reader().options(
        dbtable=table, partitionColumn=partition_column, lowerBound=low, upperBound=high,
        numPartitions=str(num_partitions),
    )
    return hwm_filter(split.load(), hwm, since)


def write_jdbc(df: DataFrame, options: Mapping[str, str], table: str, batch_size: int = 10000) -> None:
    """Replace a database table by the rows, every column as text."""
    check_identifier("table", table)
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    text.write.format("jdbc").options(**options).option("dbtable", table).option(
        "batchsize", str(batch_size)
    ).mode("overwrite").save()
