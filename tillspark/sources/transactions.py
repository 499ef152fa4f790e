"""The invoice-line feed: CSV in, typed canonical columns out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillspark.functions.dates import midnight, parsed
from tillspark.settings import Extract
from tillspark.sources.records import SOURCE_POSITION, FeedContractError, scan, split_records

__all__ = ["SOURCE_POSITION", "FeedContractError"]

NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def _or_null(value: Column, na_tokens: tuple[str, ...]) -> Column:
    return F.when(~value.isin(*na_tokens), value)


def number(value: Column) -> Column:
    """The finite number a text spells; `NaN`, `Infinity` and `1d` spell none."""
    spelt = F.when(F.trim(value).rlike(NUMBER), F.trim(value).try_cast("double"))
    return F.when(F.abs(spelt) < float("inf"), spelt)


def _whole_number(value: Column) -> Column:
    """The integer a text spells, `17` or `17.0`; null for anything fractional."""
    number_ = number(value)
    return F.when(number_ == F.floor(number_), number_.try_cast("bigint"))


def check_columns(raw: DataFrame, settings: Extract = Extract()) -> None:
    """Raise, naming them, when mapped columns are missing. Runs no job."""
    missing = sorted(set(settings.column_map) - set(raw.columns))
    if missing:
        raise FeedContractError(
            f"the feed lacks column(s) {', '.join(missing)}; "
            f"it has {', '.join(raw.columns)}; adjust column_map"
        )


def type_lines(raw: DataFrame, settings: Extract = Extract()) -> DataFrame:
    """Rename and type a frame of text columns; what cannot be read becomes null.

    No row is dropped. Codes are trimmed and upper-cased, descriptions trimmed;
    invoice numbers stay exactly as written.
    """
    check_columns(raw, settings)
    text = raw.withColumnsRenamed(settings.column_map).withColumns(
        {
            name: _or_null(F.col(name), settings.na_tokens)
            for name in settings.column_map.values()
        }
    )
    return text.withColumns(
        {
            "stock_code": F.upper(F.trim("stock_code")),
            "description": F.trim("description"),
            "quantity": number(F.col("quantity")),
            "invoice_ts": parsed(F.trim("invoice_ts"), settings.date_format),
            "unit_price": number(F.col("unit_price")),
            "customer_id": _whole_number(F.col("customer_id")),
        }
    )


def read_lines(spark: SparkSession, path: str, settings: Extract = Extract()) -> DataFrame:
    """Scan CSV files into canonical lines plus their position in the feed.

    Quotes inside quoted fields are doubled. A file whose header differs from the
    first one's, or a record with another number of fields, stops the scan with
    an error that names the file; `read_lines_kept` keeps such records. Line breaks
    inside fields need `Extract.multi_line`: such a file cannot be split, so one task
    reads it, at some 50 MB a second; feeds of that kind should come in files of up to
    a few GB.
    """
    return type_lines(scan(spark, path, settings.multi_line), settings)


def read_lines_kept(
    spark: SparkSession, path: str, settings: Extract = Extract()
) -> tuple[DataFrame, DataFrame]:
    """Canonical lines, and the records that cannot be read."""
    good, rejects = split_records(scan(spark, path, settings.multi_line, keep=True), "lines")
    return type_lines(good, settings), rejects


def extract_profile(lines: DataFrame) -> DataFrame:
    """One row: line count, distinct invoices, first and last day."""
    return lines.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("invoice_no").alias("invoices"),
        midnight(F.min("invoice_ts")).alias("first_day"),
        midnight(F.max("invoice_ts")).alias("last_day"),
    )


def check_lines(lines: DataFrame, settings: Extract = Extract()) -> None:
    """Raise when the feed is empty or none of its timestamps could be read."""
    seen = lines.agg(
        F.count(F.lit(1)).alias("rows"), F.count("invoice_ts").alias("dated")
    ).first()
    if seen["rows"] == 0:
        raise FeedContractError("the feed has no rows")
    if seen["dated"] == 0:
        raise FeedContractError(
            f"no timestamp matches '{settings.date_format}'; adjust date_format"
        )
