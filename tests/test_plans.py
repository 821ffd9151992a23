"""Plans: what is read, shuffled and broadcast, and what happens to a hot key."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from frames import RUN_DATE
from tallymark.checks.standins import Samples
from tallymark.operators.conform import conform_extract, conform_extract_by_group
from tallymark.plans.reports import build_report, index_of, ledgers_of, narrowed
from tallymark.plans.specs import NSI, PHYSICAL, REPORTS

FOLDER = "/root/testdata/sf0.001"


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def setting(spark):
    """Set session options for one test."""
    before = {}

    def put(**options):
        for key, value in options.items():
            name = "spark.sql." + key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield put
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


@pytest.mark.parametrize("name", ["profitability", "extract", "cube", "summary", "gl_export"])
def test_ledgers_read_few_columns_and_broadcast_no_lines(spark, name):
    plan = executed(Samples(spark, FOLDER).ledger(name))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
    schema = re.search(r"lineitem.*?ReadSchema: struct<(.*?)>", plan, re.S).group(1)
    assert "l_orderkey" not in schema
    if name == "gl_export":
        assert "l_partkey" not in schema
    if name in ("profitability", "cube"):
        assert "l_tax" not in schema or name == "profitability"
    # Dimension tables are the build side; the lines are streamed past them.
    assert "BuildLeft" not in plan or "lineitem" not in plan.split("BuildLeft")[-1].split("BuildRight")[0]


@pytest.mark.parametrize("spec", REPORTS, ids=lambda s: s.name)
def test_settled_reports_scan_no_source(spark, spec):
    ledgers = Samples(spark, FOLDER).ledgers(*ledgers_of(spec)).settled()
    report = build_report(ledgers, index_of(ledgers), spec, RUN_DATE, "YES")
    plan = executed(report)
    assert "lineitem" not in plan and "FullOuter" not in plan


def test_large_ledgers_stay_hashed_on_their_key(spark, setting):
    """With nothing small enough to broadcast, joins reuse the sums' partitioning."""
    setting(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    ledgers = Samples(spark, FOLDER).ledgers(*ledgers_of(NSI))
    left = ledgers.extract.select("YEAR", "PERIOD", "CODE", "NSIAVV")
    right = ledgers.cube.select("YEAR", "PERIOD", "CODE", "NSI")
    joined = executed(left.join(right, ["YEAR", "PERIOD", "CODE"], "left"))
    top = joined.split("SortMergeJoin")[1]
    # One exchange per side, the one of its own grouping, then sort and join.
    assert top.split("HashAggregate")[0].count("Exchange") == 0


def hot_extract(spark, rows=120_000):
    """A third of the lines on one article, the rest spread."""
    n = F.col("id")
    return spark.range(0, rows, 1, 16).select(
        F.when(n % 3 == 0, "hot").otherwise(F.concat(F.lit("a"), (n % 5000).cast("string"))).alias("RSART"),
        F.concat(F.lit("w"), (n % 50).cast("string")).alias("RSWHR"),
        F.lit("S").alias("RSATP"), F.lit("01").alias("RSCLS"), F.lit("99").alias("RSAVV#"),
        *[F.lit(1).cast("decimal(18,4)").alias(c) for c in ("RSQTY", "RSSALTOT", "RSAVVTOT", "RSEXAM", "RSCOGTOT")],
        F.lit(2018).alias("year"), F.lit(4).alias("period"),
    )


def hot_dimensions(spark):
    plant = spark.range(50).selectExpr(
        "concat('w', id) WHS", "lpad(cast(id % 10 as string), 3, '0') PLNT"
    )
    article = spark.range(5001).selectExpr(
        "if(id = 5000, 'hot', concat('a', id)) AM01_ARTNUM",
        "cast(2 as decimal(12,6)) AM01_ARTCNVFAC2", "'1999' AMBCPPGRP", "1999999 AM01_EFTDAT",
    )
    adjustment = spark.createDataFrame([("S", "0")], "ADJTYP string, ADJCLS string")
    return plant, article, adjustment


def test_a_hot_article_is_split(spark, setting):
    """Dimensions too large to broadcast: the hot join partition is read by several tasks."""
    setting(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        shuffle__partitions="16",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="64KB",
    )
    expected = [(f"{c:03d}", 12000.0, 24000.0) for c in range(10)]
    # The earlier form of the extract joins lines.
    grouped = hot_extract(spark).withColumn("RSMASG", F.lit("11"))
    for conformed, skewed in (
        (conform_extract_by_group(grouped, *hot_dimensions(spark)[:2]), True),
        (conform_extract(hot_extract(spark), *hot_dimensions(spark)), False),
    ):
        volumes = conformed.select("CODE", "VOLUMEPHYSICAL", "VOLUMEGLUNIT")
        rows = sorted((r[0], float(r[1]), float(r[2])) for r in volumes.collect())
        assert rows == expected
        # Where sums are joined, the hot article's lines have become few rows: nothing to split.
        assert ("skew=true" in executed(volumes)) is skewed


def test_the_first_shuffle_of_the_extract_carries_sums(spark, setting):
    setting(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    conformed = conform_extract(hot_extract(spark), *hot_dimensions(spark))
    conformed.collect()
    plan = executed(conformed)
    # Read upwards from the scan: the lines are added up before any exchange or join.
    above_scan = plan[: plan.rindex("Range (0, 120000")]
    steps = re.findall(r"partial_sum\(|Exchange hashpartitioning|SortMergeJoin", above_scan)
    assert steps[-1] == "partial_sum("


def test_sums_shrink_before_the_shuffle(spark):
    """Whatever shares a key is added up in its task; a task sends a row per code."""
    conformed = conform_extract(hot_extract(spark), *hot_dimensions(spark))
    conformed.collect()
    plan = conformed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_sum(") >= 5


def test_a_single_report_narrows_its_scans(spark):
    """The physical report needs one of the view's figures: the price is not read for it."""
    ledgers = narrowed(Samples(spark, FOLDER).ledgers(*ledgers_of(PHYSICAL)), PHYSICAL)
    plan = executed(ledgers.profitability)
    schema = re.search(r"lineitem.*?ReadSchema: struct<(.*?)>", plan, re.S).group(1)
    assert "l_quantity" in schema and "l_extendedprice" not in schema
