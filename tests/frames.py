"""Small literal frames for the tests."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallymark.functions.fiscal import FiscalPeriod
from tallymark.plans.reports import Ledgers

RUN_DATE = dt.date(2018, 5, 31)
APRIL, MAY = FiscalPeriod(2018, 4), FiscalPeriod(2018, 5)

LEDGER_COLUMNS = {
    "profitability": ["NAME", "Volume", "Wholesale", "COGS", "DISC", "NSI"],
    "extract": ["VOLUMEPHYSICAL", "VOLUMEGLUNIT", "NSIAVV", "NSIRSEXAM", "COGS"],
    "cube": ["Volume", "COGS", "NSI"],
    "gl_export": ["NAME", "TotalGrossVol", "NSISimple", "CONANSISimple", "MMNSI", "COGSSimple"],
    "physical_export": ["NAME", "VolGrossSalesVolume"],
    "summary": ["ZRVOLUME", "ZRGLVOLUME", "ZRNSI", "ZRCOGS"],
}


def decimal(value):
    return None if value is None else Decimal(str(value))


def ledger(spark: SparkSession, name: str, rows: list[tuple]) -> DataFrame:
    """A conformed ledger; each row is (year, period, code, columns...)."""
    fields = [
        T.StructField("YEAR", T.IntegerType()),
        T.StructField("PERIOD", T.IntegerType()),
        T.StructField("CODE", T.StringType()),
    ]
    for column in LEDGER_COLUMNS[name]:
        kind = T.StringType() if column == "NAME" else T.DecimalType(28, 8)
        fields.append(T.StructField(column, kind))

    def typed(row: tuple) -> tuple:
        return tuple(
            decimal(v) if isinstance(f.dataType, T.DecimalType) else v
            for v, f in zip(row, fields)
        )

    return spark.createDataFrame([typed(r) for r in rows], T.StructType(fields))


def ledgers(spark: SparkSession, **rows: list[tuple]) -> Ledgers:
    return Ledgers(**{name: ledger(spark, name, rows.get(name, [])) for name in LEDGER_COLUMNS})


def plain_rows(df: DataFrame, *columns: str) -> list[tuple]:
    """Rows as sorted tuples, decimals as floats."""
    selected = df.select(*columns) if columns else df

    def plain(value):
        return float(value) if isinstance(value, Decimal) else value

    rows = [tuple(plain(v) for v in row) for row in selected.collect()]
    return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))
