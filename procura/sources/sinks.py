"""Sinks: typed full-refresh tables (S4), materialised reports (S5), views
(S6), CSV exports (S7) and snapshot publishing (S8).

Nothing here collects rows to the driver; every write is a distributed
write of the DataFrame's partitions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from procura.session import shuffles_released
from procura.sources.buckets import write_bucketed
from procura.sources.commits import MONTH_COLUMN, Commit, Commits, Table
from procura.sources.figures import figures_of, observed



def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the declared columns in declared order, cast to declared types."""
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def _shown_order(columns) -> list:
    """Columns as sort keys: a name, or a (name, direction) pair."""
    return [sort_key(*c) if isinstance(c, tuple) else F.col(c) for c in columns]


def sort_key(column: str, direction: str):
    """The sort key of a report as it is shown: nulls are the smallest value,
    as its views sort them, unless the direction says "nulls last"."""
    c = F.col(column)
    if direction == "asc":
        return c.asc_nulls_first()
    if direction == "asc nulls last":
        return c.asc_nulls_last()
    if direction == "desc":
        return c.desc_nulls_last()
    raise ValueError(f"unknown direction {direction!r}")


def write_table(df: DataFrame, path: str, schema: StructType | None = None,
                partition_by: list[str] | None = None, sort_within: list | None = None,
                month_of: str | None = None, range_by: list | None = None, find_by: dict[str, int] | None = None,
                buckets: dict | None = None) -> Table:
    """Replace a table with ``df`` (optionally conformed to ``schema``)
    and return its declaration with the figures of the write (rows, nulls and
    checksum per column; no second pass).

    ``month_of`` adds the month of that date as partition column.
    ``sort_within`` orders rows inside each output partition so parquet
    row-group statistics become selective on those columns (the columnar
    counterpart of a secondary index); there is no global sort.  With
    ``range_by`` the files, too, follow one another in that order (within a
    month, if there are months), so the first rows stand in the first files.
    ``find_by`` gives columns a Bloom filter (column -> distinct values
    expected in a row group), for look-ups of single values.
    ``buckets`` (``by``, ``count``, ``sort_by``) deals the rows into buckets."""
    if schema is not None:
        df = conform(df, schema)
    if buckets:
        declared, figures = write_bucketed(df, path, **buckets)
        return Table(path, df.schema.json(), figures, declared)
    if month_of:
        df = df.withColumn(MONTH_COLUMN, F.date_format(month_of, "yyyy-MM"))
        partition_by = [*(partition_by or []), MONTH_COLUMN]
    if range_by:
        order = [*([F.col(MONTH_COLUMN)] if month_of else []), *_shown_order(range_by)]
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    else:
        if month_of:
            # one writer per month and day range: few files, a hot month still spreads
            df = df.repartition(MONTH_COLUMN, F.dayofmonth(month_of), F.pmod(F.xxhash64(*df.columns[:8]), F.lit(8)))
            sort_within = [MONTH_COLUMN, *(sort_within or [])]
        if sort_within:
            df = df.sortWithinPartitions(*_shown_order(sort_within))
    df, seen = observed(df)
    w = df.write.mode("overwrite")
    for column, distinct in (find_by or {}).items():
        w = w.option(f"parquet.bloom.filter.enabled#{column}", "true").option(
            f"parquet.bloom.filter.expected.ndv#{column}", str(distinct))
    if partition_by:
        w = w.partitionBy(*partition_by)
    with shuffles_released(df.sparkSession):
        w.parquet(path)
    return Table(path, df.schema.json(), figures_of(seen, df.columns))


def save_report(df: DataFrame, name: str, path: str | None = None) -> None:
    """Materialise a report as a table (a catalog table, or parquet at
    ``path``)."""
    w = df.write.mode("overwrite")
    with shuffles_released(df.sparkSession):
        if path is None:
            w.saveAsTable(name)
        else:
            w.parquet(path)


def register_views(views: dict[str, DataFrame]) -> list[str]:
    """Register DataFrames as temporary views for SQL."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)


def export_csv(df: DataFrame, path: str, headers: dict[str, str] | None = None) -> None:
    """CSV export with a header line, unlimited size (one file per
    partition, written in parallel; the part files of a sorted report follow
    one another in its order).  ``headers`` renames columns to the export's
    column titles; nested arrays are written as JSON text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.dataType.typeName() in ("array", "struct", "map"):
            c = F.to_json(c, {"ignoreNullFields": "false"})
        cols.append(c.alias((headers or {}).get(f.name, f.name)))
    w = df.select(*cols).write.mode("overwrite").option("header", True).option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    with shuffles_released(df.sparkSession):
        w.csv(path)


def publish_snapshot(spark: SparkSession, tables: dict[str, DataFrame], root: str,
                     label: str | None = None, layout: dict[str, dict] | None = None,
                     written: dict[str, Table] | None = None, expected: int | None = None) -> str:
    """Build every table under a fresh ``root/snapshot=<label>/`` folder,
    then commit the snapshot (see :mod:`procura.sources.commits`).  Readers of
    the current snapshot never see a half-written table, on any file system.
    ``written`` are tables that are in place already (of this snapshot, or
    carried over from an earlier one); ``expected`` refuses to replace a
    snapshot other than the commit of that number."""
    label = label or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%fZ")
    base = snapshot_folder(root, label)
    done = dict(written or {})
    for name, df in tables.items():
        done[name] = write_table(df, f"{base}/{name}", **(layout or {}).get(name, {}))
    Commits.at(spark, root).add(label, base, done, expected)
    return base


def snapshot_folder(root: str, label: str) -> str:
    return f"{root.rstrip('/')}/snapshot={label}"


def current_commit(spark: SparkSession, root: str) -> Commit:
    """The commit of the currently published snapshot (a few kilobytes, read
    on the driver, no job)."""
    commit = Commits.at(spark, root).latest()
    if commit is None:
        raise FileNotFoundError(f"no snapshot is published under {root}")
    return commit


def current_snapshot(spark: SparkSession, root: str) -> str:
    """Folder of the currently published snapshot."""
    return current_commit(spark, root).base


def open_snapshot(spark: SparkSession, root: str, database: str | None = None) -> list[str]:
    """Register every table of the current snapshot as a view, so reports are
    browsed and queried as published, without computing them.

    Without ``database`` the views are temporary.  With it they are views of
    that database in the session's catalog (created if absent): all sessions
    that share the catalog see them, they stay when this session ends, and
    opening a later snapshot replaces them one by one.  Such a view names its
    snapshot's folder, so it goes on reading that snapshot until it is replaced."""
    tables = current_commit(spark, root).tables
    if database is None:
        return register_views({n: t.read(spark) for n, t in tables.items()})
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, table in tables.items():
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS {table.sql()}")
    return sorted(tables)


def read_current(spark: SparkSession, root: str, name: str) -> DataFrame:
    return current_commit(spark, root).tables[name].read(spark)
