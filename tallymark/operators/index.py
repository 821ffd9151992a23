"""Which system a cost centre is booked in, and the name it goes by."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.fiscal import FiscalPeriod
from tallymark.operators.align import codes_in, codes_not_in
from tallymark.operators.keys import KEYS, NAME, PERIOD, YEAR

# The two tags, and the last period in which only cost centres with
# volume count as moved to the new system.
MOVED, NOT_MOVED = "CONA", "Legacy"
LAST_PERIOD_BY_VOLUME = FiscalPeriod(2018, 4)


def system_index(profitability: DataFrame, extract: DataFrame, gl_export: DataFrame) -> DataFrame:
    """Codes of the profitability view, then those only the extract has and a report names."""
    last_year, last_period = LAST_PERIOD_BY_VOLUME
    after = (F.col(YEAR) > last_year) | (
        (F.col(YEAR) == last_year) & (F.col(PERIOD) > last_period)
    )
    moved = profitability.where(after | (F.col("Volume") != 0))
    only_in_extract = codes_not_in(extract, profitability, KEYS)
    not_moved = codes_in(gl_export, only_in_extract, KEYS)
    return moved.select(*KEYS, NAME, F.lit(MOVED).alias("System")).unionByName(
        not_moved.select(*KEYS, NAME, F.lit(NOT_MOVED).alias("System"))
    )
