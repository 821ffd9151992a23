"""The four reports, declared: which figures to align and which variances to take."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallymark.functions import measures
from tallymark.functions.measures import fill_zero


@dataclass(frozen=True)
class Variance:
    """``base - other``, or ``base + other`` for a ledger booked with opposite sign."""

    name: str
    base: str
    other: str
    fallback: str | None = None
    sign: int = -1


@dataclass(frozen=True)
class Side:
    """One ledger's part in a report, in the order its steps apply.

    ``figures`` maps the ledger's columns to the report's. ``filled`` turns null into 0
    before the variances, so an absent figure counts as 0; ``zeroed`` does so after
    them, so an absent figure gives no variance.
    """

    ledger: str
    figures: dict[str, str]
    filled: tuple[str, ...] = ()
    variances: tuple[Variance, ...] = ()
    zeroed: tuple[str, ...] = ()
    required: bool = False

    def apply(self, aligned: DataFrame, fill: bool = True) -> DataFrame:
        if fill:
            aligned = fill_zero(aligned, self.filled)
        aligned = aligned.withColumns(
            {v.name: measures.variance(v.base, v.other, v.fallback, v.sign) for v in self.variances}
        ) if self.variances else aligned
        return fill_zero(aligned, self.zeroed)


@dataclass(frozen=True)
class ReportSpec:
    name: str
    sides: tuple[Side, ...]
    figures: tuple[str, ...]
    fill_rest: bool = True

    def stored_schema(self) -> T.StructType:
        """Columns of the report as its history table stores them."""
        text, number = T.StringType(), T.IntegerType()
        columns = {"CODE": text, "COSTCENTER": text}
        columns |= {figure.upper(): measures.MEASURE for figure in self.figures}
        columns |= {"DATE": T.DateType(), "PERIOD": number, "YEAR": number}
        columns |= {"PERIODEND": text, "SYSTEM": text}
        return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Columns of the report, their order, and what each variance takes.
PHYSICAL = ReportSpec(
    name="physical",
    sides=(
        Side("profitability", {"Volume": "HANAVOLUME"}),
        Side(
            "extract",
            {"VOLUMEPHYSICAL": "KOEXTTVOLUME"},
            filled=("KOEXTTVOLUME",),
            # The extract is its own fallback: no reference, no variance.
            variances=(Variance("KOEXTTVAR", "HANAVOLUME", "KOEXTTVOLUME", "KOEXTTVOLUME"),),
        ),
        Side(
            "physical_export",
            {"VolGrossSalesVolume": "MMVOLUME"},
            filled=("MMVOLUME",),
            variances=(Variance("MMVAR", "HANAVOLUME", "MMVOLUME", "KOEXTTVOLUME"),),
        ),
        Side(
            "summary",
            {"ZRVOLUME": "ZRVOLUME"},
            variances=(Variance("ZRVAR", "HANAVOLUME", "ZRVOLUME", "KOEXTTVOLUME"),),
            zeroed=("ZRVOLUME", "ZRVAR"),
        ),
    ),
    figures=(
        "HANAVOLUME", "KOEXTTVOLUME", "KOEXTTVAR", "MMVOLUME", "MMVAR", "ZRVOLUME", "ZRVAR",
    ),
    fill_rest=False,
)

# Columns of the report, their order, and what each variance takes.
GL = ReportSpec(
    name="gl",
    sides=(
        Side("gl_export", {"TotalGrossVol": "MMVOLUME"}, required=True),
        Side(
            "extract",
            {"VOLUMEGLUNIT": "VOLUMEGLUNIT"},
            variances=(Variance("MMVAR", "VOLUMEGLUNIT", "MMVOLUME"),),
        ),
        Side(
            "cube",
            {"Volume": "BWVOLUME"},
            variances=(Variance("BWVAR", "VOLUMEGLUNIT", "BWVOLUME", sign=+1),),
        ),
        Side(
            "summary",
            {"ZRGLVOLUME": "ZRGLVOLUME"},
            variances=(Variance("ZRVAR", "VOLUMEGLUNIT", "ZRGLVOLUME"),),
            zeroed=("ZRGLVOLUME", "ZRVAR"),
        ),
    ),
    figures=(
        "MMVOLUME", "VOLUMEGLUNIT", "MMVAR", "BWVOLUME", "BWVAR", "ZRGLVOLUME", "ZRVAR",
    ),
)

# Columns of the report, their order, and what each variance takes.
NSI = ReportSpec(
    name="nsi",
    sides=(
        Side("profitability", {"NSI": "HANANSI"}),
        Side(
            "extract",
            {"NSIAVV": "KOEXTTAVV", "NSIRSEXAM": "KOEXTTRSEXAM"},
            filled=("KOEXTTAVV",),
            variances=(
                Variance("KOEXTTAVVVAR", "HANANSI", "KOEXTTAVV", "KOEXTTAVV"),
                Variance("KOEXTTRSEXAMVAR", "HANANSI", "KOEXTTRSEXAM", "KOEXTTRSEXAM"),
            ),
        ),
        Side(
            "gl_export",
            {"NSISimple": "NSISimple", "CONANSISimple": "CONANSISimple", "MMNSI": "MMNSI"},
            filled=("NSISimple", "CONANSISimple", "MMNSI"),
            variances=(
                Variance("MMSimpleVAR", "HANANSI", "NSISimple", "KOEXTTRSEXAM"),
                Variance("MMCONAVAR", "HANANSI", "CONANSISimple", "KOEXTTRSEXAM"),
                Variance("MMNSIVAR", "HANANSI", "MMNSI", "KOEXTTRSEXAM"),
            ),
        ),
        Side(
            "cube",
            {"NSI": "BWNSI"},
            variances=(Variance("BWVAR", "HANANSI", "BWNSI", "KOEXTTRSEXAM", sign=+1),),
        ),
        Side(
            "summary",
            {"ZRNSI": "ZRNSI"},
            variances=(Variance("ZRVAR", "HANANSI", "ZRNSI", "KOEXTTRSEXAM"),),
            zeroed=("ZRNSI", "ZRVAR"),
        ),
    ),
    figures=(
        "HANANSI", "KOEXTTAVV", "KOEXTTAVVVAR", "KOEXTTRSEXAM", "KOEXTTRSEXAMVAR",
        "NSISimple", "CONANSISimple", "MMNSI", "MMSimpleVAR", "MMCONAVAR", "MMNSIVAR",
        "BWNSI", "BWVAR", "ZRNSI", "ZRVAR",
    ),
)

# Columns of the report, their order, and what each variance takes.
COGS = ReportSpec(
    name="cogs",
    sides=(
        Side("profitability", {"COGS": "HANACOGS"}),
        Side(
            "extract",
            {"COGS": "KOEXTTCOGS"},
            filled=("KOEXTTCOGS",),
            variances=(Variance("KOEXTTVAR", "HANACOGS", "KOEXTTCOGS", "KOEXTTCOGS"),),
        ),
        Side(
            "gl_export",
            {"COGSSimple": "MMCOGS"},
            filled=("MMCOGS",),
            variances=(Variance("MMVAR", "HANACOGS", "MMCOGS", "KOEXTTCOGS"),),
        ),
        Side(
            "cube",
            {"COGS": "BWCOGS"},
            variances=(Variance("BWVAR", "HANACOGS", "BWCOGS", "KOEXTTCOGS"),),
        ),
        Side(
            "summary",
            {"ZRCOGS": "ZRCOGS"},
            variances=(Variance("ZRVAR", "HANACOGS", "ZRCOGS", "KOEXTTCOGS"),),
            zeroed=("ZRCOGS", "ZRVAR"),
        ),
    ),
    figures=(
        "HANACOGS", "KOEXTTCOGS", "KOEXTTVAR", "MMCOGS", "MMVAR", "BWCOGS", "BWVAR",
        "ZRCOGS", "ZRVAR",
    ),
)

REPORTS = (PHYSICAL, GL, NSI, COGS)
