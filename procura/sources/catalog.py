"""Source relations from storage (S3): parquet folders or a JDBC database.

A :class:`SourceCatalog` exposes every source relation the marts read as a
lazy DataFrame attribute, like :class:`procura.sources.testdata.TestSources`.
Base tables are read whole and filtered / joined in Spark, so Catalyst pushes
predicates and column pruning into the scan; no SQL text is shipped to the
source.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from procura.sources.files import (FISCAL_FUND_COLUMNS, FISCAL_VENDOR_COLUMNS, broken_rows, read_fiscal_funds,
                                   read_fiscal_vendors)

# Every relation the marts read (besides the two fiscal office files).
SOURCE_RELATIONS = (
    "record_metadata", "varfield", "varfield_type", "varfield_type_name", "record_type", "record_type_name",
    "fund_master", "accounting_unit", "fund_myuser", "external_fund_property", "external_fund_property_name",
    "invoice_record", "invoice_record_line", "invoice_record_vendor_summary",
    "order_record", "order_record_cmf", "order_record_received", "bib_record_order_record_link",
    "form_property", "form_property_name", "order_status_property", "order_status_property_name",
    "order_type_property_myuser", "vendor_record", "vendor_record_address", "vendor_record_address_type",
)

# Columns that large relations are split by over JDBC: the key, and the row's
# own id, which splits the rows of one key.
JDBC_KEYS = {"record_metadata": ("id",), "varfield": ("record_id", "id"), "invoice_record_line": ("invoice_record_id", "id"),
             "invoice_record": ("record_id",), "order_record": ("record_id",), "order_record_cmf": ("order_record_id", "id"),
             "order_record_received": ("order_record_id", "id")}
ROWS_PER_PARTITION = 1_000_000
FETCH_ROWS = 10_000


def split_query(table: str, key: tuple[str, ...], rows_per_partition: int = ROWS_PER_PARTITION) -> str:
    """SQL for the first key of every part but the first: parts have equally
    many rows, however the keys are spread."""
    columns, known = ", ".join(key), " and ".join(f"{k} is not null" for k in key)
    return (f"(select {columns} from (select {columns}, row_number() over (order by {columns}) - 1 as place_"
            f" from {table} where {known}) numbered where place_ > 0 and mod(place_, {rows_per_partition}) = 0"
            f") splits")


def _literal(value) -> str:
    return str(value) if isinstance(value, int) else "'" + str(value).replace("'", "''") + "'"


def _at_or_after(key: tuple[str, ...], values: tuple) -> str:
    """(key) >= (values), column by column."""
    head, rest = f"{key[0]} > {_literal(values[0])}", f"{key[0]} = {_literal(values[0])}"
    if len(key) == 1:
        return f"{key[0]} >= {_literal(values[0])}"
    return f"({head} or ({rest} and {_at_or_after(key[1:], values[1:])}))"


def _before(key: tuple[str, ...], values: tuple) -> str:
    head, rest = f"{key[0]} < {_literal(values[0])}", f"{key[0]} = {_literal(values[0])}"
    if len(key) == 1:
        return head
    return f"({head} or ({rest} and {_before(key[1:], values[1:])}))"


def split_predicates(key: tuple[str, ...], splits: list[tuple]) -> list[str]:
    """One WHERE clause per part; every row meets exactly one, rows with a
    null in the key the first."""
    splits = sorted(splits)
    out = []
    for lower, upper in zip([None, *splits], [*splits, None]):
        ends = ([_at_or_after(key, lower)] if lower else []) + ([_before(key, upper)] if upper else [])
        clause = " and ".join(ends)
        if lower is None and clause:
            clause = " or ".join([f"({clause})", *[f"{k} is null" for k in key]])
        out.append(clause or "1 = 1")
    return out


class SourceCatalog:
    """Source relations by name; ``readers`` maps a name to a DataFrame factory."""

    def __init__(self, spark: SparkSession, readers: dict[str, Callable[[], DataFrame]]):
        self.spark = spark
        self._readers = readers
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._readers:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self._readers[name]()
        return self._cache[name]

    @classmethod
    def parquet(cls, spark: SparkSession, root: str, fiscal_vendors_csv: str | None = None,
                fiscal_funds_csv: str | None = None, csv_titles: dict[str, str] | None = None) -> "SourceCatalog":
        """One parquet folder per relation under ``root``; the two fiscal
        office lists from CSV files if given (``csv_titles`` maps the files'
        column titles to the column names)."""
        root = root.rstrip("/")
        readers: dict[str, Callable[[], DataFrame]] = {
            n: (lambda n=n: spark.read.parquet(f"{root}/{n}")) for n in SOURCE_RELATIONS}
        for n in ("fiscal_vendors", "fiscal_funds"):
            readers[n] = lambda n=n: spark.read.parquet(f"{root}/{n}")
        readers.update(_fiscal_readers(spark, fiscal_vendors_csv, fiscal_funds_csv, csv_titles))
        return cls(spark, readers)

    @classmethod
    def jdbc(cls, spark: SparkSession, url: str, properties: dict[str, str], schema: str,
             fiscal_vendors_csv: str, fiscal_funds_csv: str,
             keys: dict[str, tuple[str, ...]] | None = None, rows_per_partition: int = ROWS_PER_PARTITION,
             csv_titles: dict[str, str] | None = None) -> "SourceCatalog":
        """Relations of a JDBC source (``schema.relation``).  Relations with a
        key (``JDBC_KEYS``, ``keys``) are read in parallel parts of
        ``rows_per_partition`` rows: the source numbers the keys and names the
        first of each part, so a key range that holds most of the rows, or one
        key that does, is read by as many tasks as any other rows.

        Every relation is read on its own; a source that changes meanwhile is
        read at different moments (read from a standby or a dump if that
        matters)."""
        keys = {**JDBC_KEYS, **(keys or {})}
        properties = {"fetchsize": str(FETCH_ROWS), **properties}

        def reader(name: str) -> Callable[[], DataFrame]:
            table = f"{schema}.{name}"

            def read() -> DataFrame:
                if name not in keys:
                    return spark.read.jdbc(url, table, properties=properties)
                key = keys[name]
                splits = spark.read.jdbc(url, split_query(table, key, rows_per_partition), properties=properties).collect()
                if not splits:
                    return spark.read.jdbc(url, table, properties=properties)
                return spark.read.jdbc(url, table, predicates=split_predicates(key, [tuple(s) for s in splits]),
                                       properties=properties)
            return read

        readers = {n: reader(n) for n in SOURCE_RELATIONS}
        readers.update(_fiscal_readers(spark, fiscal_vendors_csv, fiscal_funds_csv, csv_titles))
        return cls(spark, readers)


def _fiscal_readers(spark: SparkSession, vendors_csv: str | None, funds_csv: str | None,
                    titles: dict[str, str] | None) -> dict[str, Callable[[], DataFrame]]:
    """The two lists from CSV files, each with its rows that are broken."""
    out: dict[str, Callable[[], DataFrame]] = {}
    for name, path, read, columns in (("fiscal_vendors", vendors_csv, read_fiscal_vendors, FISCAL_VENDOR_COLUMNS),
                                      ("fiscal_funds", funds_csv, read_fiscal_funds, FISCAL_FUND_COLUMNS)):
        if path:
            out[name] = lambda path=path, read=read: read(spark, path, titles)
            out[f"{name}_broken"] = lambda path=path, columns=columns: broken_rows(spark, path, columns, titles)
    return out


def export_sources(sources, root: str, names: tuple[str, ...] = SOURCE_RELATIONS + ("fiscal_vendors",
                                                                                    "fiscal_funds")) -> None:
    """Write every source relation of ``sources`` as parquet under ``root``
    (e.g. to snapshot a source system, or to turn the test mapping into
    stored tables)."""
    for n in names:
        getattr(sources, n).write.mode("overwrite").parquet(f"{root.rstrip('/')}/{n}")
