"""CSV lookups (zones, rate codes, payment types) and their fixed seed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starlane.sources.series import literal_rows

ZONE_SCHEMA = "LocationID int, Borough string, Zone string, service_zone string"
RATE_CODE_SCHEMA = "rate_code_id int, rate_code_name string, description string"
PAYMENT_TYPE_SCHEMA = "payment_type_id int, payment_name string, is_cash boolean"

# The rate-code seed (id, name, description); 99 = unknown.
RATE_CODES = [
    (1, "Standard rate", "Standard metered fare"),
    (2, "JFK", "JFK Airport flat fare"),
    (3, "Newark", "Newark Airport flat fare"),
    (4, "Nassau or Westchester", "Trips to Nassau or Westchester counties"),
    (5, "Negotiated fare", "Pre-negotiated fare"),
    (6, "Group ride", "Shared ride fare"),
    (99, "Unknown", "Unknown or missing rate code"),
]

# The payment-type seed (id, name, is_cash); 0 and 99 unknown.
PAYMENT_TYPES = [
    (0, "Not specified", False),
    (1, "Credit card", False),
    (2, "Cash", True),
    (3, "No charge", False),
    (4, "Dispute", False),
    (5, "Unknown", False),
    (6, "Voided trip", False),
    (99, "Unknown", False),
]


def read_lookup(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A quoted, header-first CSV lookup with a declared schema.

    CRLF line ends are handled; the text "N/A" stays text (no null value
    is configured), as the reference's seed loader keeps it.
    """
    return (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .schema(schema)
        .csv(path)
    )


def write_lookup(df: DataFrame, path: str) -> str:
    """Write a lookup as quoted CSV files with a header and CRLF line ends."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quoteAll", True)
        .option("lineSep", "\r\n")
        .csv(path)
    )
    return path


def lookup_count(spark: SparkSession, path: str, schema: str) -> int:
    """Data rows of a CSV lookup (records, not lines; the header is not counted)."""
    return read_lookup(spark, path, schema).count()


def rate_codes(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, RATE_CODES, RATE_CODE_SCHEMA)


def payment_types(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, PAYMENT_TYPES, PAYMENT_TYPE_SCHEMA)
