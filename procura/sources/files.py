"""CSV sources of the fiscal office (S1 vendors, S2 fund to ledger mapping).

The fund mapping file exists in several layouts: with or without a leading
``rowid`` column, quoted or not, LF or CRLF line ends, empty ``GLKey`` or
numeric code.  Columns are therefore read by header title as text and cast
explicitly; the ledger key is a ``bigint`` (values beyond 32 bits occur).

A line with more or fewer values than the header has titles is broken: its
values cannot be told apart safely, so it is not loaded.  :func:`broken_rows`
has these lines as they stand in the file; the refresh publishes them beside
the list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

FISCAL_VENDOR_COLUMNS = {
    "FiscalVendorId": "int",
    "FiscalVendorCode": "string",
    "VendorName": "string",
    "IlsVendorCode": "string",
}

FISCAL_FUND_COLUMNS = {
    "FiscalFundId": "int",
    "FundName": "string",
    "IlsFundCode": "string",
    "IlsFundCodeNumeric": "int",
    "IlsFundCodeSpaces": "string",
    "GLKey": "bigint",
    "GLObj": "int",
}


#: Columns whose title carries the name of the library system in front; any
#: such title is accepted if exactly one column of the file ends this way.
TITLE_ENDS = {"IlsFundCode": "FundCode", "IlsFundCodeNumeric": "FundCodeNumeric",
              "IlsFundCodeSpaces": "FundCodeSpaces", "IlsVendorCode": "VendorCode"}


def _match_titles(found: list[str], columns: dict[str, str], titles: dict[str, str] | None) -> dict[str, str]:
    """Column name -> title in the file; an unmatched column is an error."""
    clean = {c.strip().lstrip("\ufeff"): c for c in found}
    named = {v: k for k, v in (titles or {}).items()}
    out = {}
    for name in columns:
        title = named.get(name, name)
        if title in clean:
            out[name] = clean[title]
        elif name in TITLE_ENDS and name not in named:
            ends = [c for c in clean if c.endswith(TITLE_ENDS[name]) and c not in columns]
            if len(ends) == 1:
                out[name] = clean[ends[0]]
    missing = [name for name in columns if name not in out]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in the file's header ({', '.join(clean)}); "
                         "name the titles of such columns")
    return out


BROKEN = "_broken_line"


def _raw(spark: SparkSession, path: str) -> DataFrame:
    """All lines as text; of a broken one the line itself is in ``BROKEN``."""
    def reader():
        return (spark.read.option("header", True).option("inferSchema", False)
                .option("quote", '"').option("escape", '"').option("ignoreTrailingWhiteSpace", True))

    titles = reader().csv(path).columns
    schema = StructType([StructField(t, StringType()) for t in [*titles, BROKEN]])
    # all columns are parsed whichever are asked for: a line's length is judged by them
    return (reader().schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BROKEN)
            .option("columnPruning", False).csv(path))


def _whole(raw: DataFrame) -> Column:
    """True for lines that are not broken.  (Spark refuses to read the column
    of broken lines alone, so another one is asked for beside it.)"""
    beside = F.length(F.concat_ws("", F.col(f"`{raw.columns[0]}`"))) >= 0  # always so
    return F.col(BROKEN).isNull() & beside


def _text(title: str) -> Column:
    v = F.trim(F.col(f"`{title}`"))
    return F.when(v == "", F.lit(None)).otherwise(v)


def _read_typed(spark: SparkSession, path: str, columns: dict[str, str],
                titles: dict[str, str] | None = None) -> DataFrame:
    """Read a header CSV as text and cast by column name.  ``titles`` maps
    column titles used in the file to the column names above; other titles are
    ignored.  A missing column raises at once, a malformed number when the
    rows are read (:func:`rejected_values` counts them); broken lines are left
    out (:func:`broken_rows` has them)."""
    raw = _raw(spark, path)
    title = _match_titles(raw.columns[:-1], columns, titles)
    out = []
    for name, typ in columns.items():
        v = _text(title[name])
        if typ != "string":
            bad = v.isNotNull() & v.try_cast(typ).isNull()
            v = F.when(bad, F.raise_error(F.concat(F.lit(f"{name} is no {typ}: "), v)).cast(typ)).otherwise(v.try_cast(typ))
        out.append(v.alias(name))
    return raw.filter(_whole(raw)).select(*out)


def broken_rows(spark: SparkSession, path: str, columns: dict[str, str], titles: dict[str, str] | None = None) -> DataFrame:
    """The lines with too many or too few values: ``file`` and ``line``."""
    raw = _raw(spark, path)
    _match_titles(raw.columns[:-1], columns, titles)
    return raw.filter(~_whole(raw)).select(
        F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"), F.col(BROKEN).alias("line"))


def rejected_values(spark: SparkSession, path: str, columns: dict[str, str],
                    titles: dict[str, str] | None = None) -> DataFrame:
    """One row: the number of broken lines and, for each typed column, of
    malformed values in the others."""
    raw = _raw(spark, path)
    title = _match_titles(raw.columns[:-1], columns, titles)
    whole = _whole(raw)
    return raw.agg(*[F.count_if(whole & _text(title[n]).isNotNull() & _text(title[n]).try_cast(t).isNull()).alias(n)
                     for n, t in columns.items() if t != "string"], F.count_if(~whole).alias("broken_lines"))


def read_fiscal_vendors(spark: SparkSession, path: str, titles: dict[str, str] | None = None) -> DataFrame:
    """Fiscal office vendor list."""
    return _read_typed(spark, path, FISCAL_VENDOR_COLUMNS, titles)


def read_fiscal_funds(spark: SparkSession, path: str, titles: dict[str, str] | None = None) -> DataFrame:
    """Fund to general-ledger mapping; any extra column (``rowid``) is
    dropped, columns are matched by name."""
    return _read_typed(spark, path, FISCAL_FUND_COLUMNS, titles)
