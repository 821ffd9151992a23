"""Schemas of the landed extracts, and the check that a frame meets one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions.measures import FACTOR, MONEY
from tallymark.functions.text import right_trimmed

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "date": T.DateType(),
    "money": MONEY,
    "factor": FACTOR,
}


def _schema(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in columns.items()])


CALENDAR = _schema(PERIOD="int", USADAT="date")

CUBE = _schema(
    COSTCENTER="string", COSTELMNT="string", VTYPE="int", VERSION="int",
    AMOUNT="money", QUANTITY="money", FISCPER="string",
)

ACCOUNT_MAP = _schema(element="string", account_class="string")

EXTRACT = T.StructType(
    [
        T.StructField(name, _TYPES[kind])
        for name, kind in (
            ("RSMATL", "string"), ("RSWHR", "string"), ("RSAVV#", "string"), ("RSDAT", "int"),
            ("RSART", "string"), ("RSMASG", "string"), ("RSCLS", "string"), ("RSATP", "string"),
            ("RSPERD", "string"), ("RSQTY", "money"), ("RSSALTOT", "money"),
            ("RSCOGTOT", "money"), ("RSAVVTOT", "money"), ("RSSPCQTY", "money"),
            ("RSEXAM", "money"), ("year", "int"), ("period", "int"),
        )
    ]
)

PLANT = _schema(WHS="string", PLNT="string")

ARTICLE = _schema(
    AM01_ARTNUM="string", AM01_ARTCNVFAC2="factor", AMBCPPGRP="string",
    COMATASGP="string", AM01_EFTDAT="int",
)

ADJUSTMENT_TYPE = _schema(ADJTYP="string", ADJCLS="string")

SUMMARY = _schema(
    RSWHR="string", PRDDESC="string", VOLPHYBCPP="money", VOLGLUBCPP="money",
    NSISM="money", COGBCPP="money", fiscal_year="int", PERIOD="int",
)

SNAPSHOT = _schema(
    Number="int", ProfitCenterName="string", ProfitCenterCode="string", Volume="money",
    Wholesale="money", COGS="money", DISC="money", NSI="money", YEAR="int", PERIOD="int",
)

# The columns of the profitability view, in its order.
PROFITABILITY = T.StructType(
    [
        *[
            T.StructField(name, T.StringType())
            for name in (
                "ProfitCenterText", "ProfitCenter", "FiscalYearPeriod",
                "MaterialAccountAssignmentGroup",
            )
        ],
        *[
            T.StructField(name, MONEY)
            for name in (
                "VV998QPhysicalCases",
                "ERLOSRevenue",
                "VV004UpchargeChannel",
                "VV076COGSPurchasedFG",
                "VV078COGSConcentrate",
                "VV079COGSIngredients",
                "VV080COGSContainers",
                "VV081COGSPackaging",
                "VV082COGSLaborActivity",
                "VV083COGSOtherOverheads",
                "VV084Reserve50CGS",
                "VV010EDVChannelDiscount",
                "VV011EDVCustomer",
                "VV013EmployeeDiscounts",
                "VV022NMDOTHER",
                "VV044CRMTPMOnInv",
                "VV023VolumeDiscount",
                "VV063Reserve35Swire",
            )
        ],
    ]
)


def _export(*figures: str) -> T.StructType:
    texts = ["Act.Cost.Cntr", "Act.Cost.Cntr.host.code"]
    numbers = [T.StructField(n, T.IntegerType()) for n in ("YEAR", "PERIOD")]
    return T.StructType(
        [
            *[T.StructField(n, T.StringType()) for n in texts],
            *[T.StructField(n, MONEY) for n in figures],
            *numbers,
            T.StructField("PERIOD_END", T.StringType()),
        ]
    )


# Headers of the two exported reports.
GL_EXPORT = _export(
    "Total.Gross.Vol", "NSI.Simple", "[Cona.NSI.Simple]$Cona_Sales", "NSI", "COGS.Simple"
)
PHYSICAL_EXPORT = _export("Vol.Gross.Sales.Volume")


def meet_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast the columns of ``schema``; text loses the blanks that pad it.

    The systems of origin ignore trailing blanks when they compare text and Spark
    does not, so codes are trimmed once here instead of in every join.
    """
    present = {name.lower(): name for name in df.columns}
    missing = [f.name for f in schema.fields if f.name.lower() not in present]
    if missing:
        raise ValueError(f"columns missing from the extract: {', '.join(missing)}")

    def landed(field: T.StructField):
        column = F.col(f"`{present[field.name.lower()]}`")
        if isinstance(field.dataType, T.StringType):
            column = right_trimmed(column.cast("string"))
        return column.cast(field.dataType).alias(field.name)

    return df.select(*[landed(f) for f in schema.fields])
