"""Exported report files: read, drop the totals line, clean the headers."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The punctuation removed from headers, the label of the totals
# line, and the two headers that get the name the reports use.
HEADER_PUNCTUATION = ".[]$"
TOTALS_LABEL = "Totals"
RENAMED_HEADERS = {"ConaNSISimpleCona_Sales": "CONANSISimple", "NSI": "MMNSI"}

LABEL_HEADER = "Act.Cost.Cntr"


def read_export_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV export with a header line; the schema is given, so no pass to infer it.

    A header that differs from the schema in a name or in the order of its columns, and
    a line that does not fit it, stop the read.
    """
    return spark.read.csv(
        path, header=True, schema=schema, enforceSchema=False, mode="FAILFAST"
    )


def of_period_ends(export: DataFrame, closed: Column, opened: Column) -> DataFrame:
    """Period-end rows of closed periods and running rows of open ones.

    A landed export holds both files of a period, told apart by ``PERIOD_END``; the
    conditions say which periods are closed and which are open.
    """
    ended = F.col("PERIOD_END") == "YES"
    return export.where((ended & closed) | (~ended & opened))


def clean_headers(df: DataFrame) -> DataFrame:
    """Take the punctuation out of every header and apply the two renames."""
    unwanted = re.compile(f"[{re.escape(HEADER_PUNCTUATION)}]")
    cleaned = [unwanted.sub("", c) for c in df.columns]
    return df.toDF(*[RENAMED_HEADERS.get(c, c) for c in cleaned])


def upper_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def clean_export(df: DataFrame, label: str = LABEL_HEADER) -> DataFrame:
    """Report rows without the totals line, under clean headers."""
    return clean_headers(df.where(F.col(f"`{label}`") != TOTALS_LABEL))
