"""The sample tables in the shape of the landed extracts.

The sample tables are order lines, suppliers and parts. Each function here maps
them to one extract's schema, over all rows, so that the registered queries run
the library's own operators: a supplier is a warehouse, its nation a cost centre,
a part an article, an order line an invoice line, a posting or a sale.

Years are moved by ``YEAR_SHIFT`` so that the periods fall on both sides of the
index rule's cut. With ``gaps`` every system lacks one region, so that every side of
an alignment has codes the others do not; queries of one system have no gaps.

Joins go from the lines to one table at a time. Joining the small tables to each
other first would make Spark multiply their sizes and think the result too large
to broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.measures import FACTOR, MONEY
from tallymark.operators import conform
from tallymark.plans.reports import Ledgers
from tallymark.sources.accounts import default_account_map

YEAR_SHIFT = 19
MISSING = {
    "profitability": "AFRICA",
    "cube": "AMERICA",
    "summary": "ASIA",
    "exports": "EUROPE",
    "extract": "MIDDLE EAST",
}
NO_VOLUME_REGION = "AMERICA"

MONEY_SQL, FACTOR_SQL = MONEY.simpleString(), FACTOR.simpleString()
FISCAL_KEY = "concat(year, '0', lpad(period, 2, '0'))"
MATERIAL_GROUP = "case l_returnflag when 'A' then '11' when 'R' then '18' else '30' end"


class Samples:
    """The sample tables of one folder, as extracts and as conformed ledgers."""

    def __init__(self, spark: SparkSession, folder: str, gaps: bool = True):
        self.spark = spark
        self.folder = folder
        self.missing = MISSING if gaps else {}
        self.tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A sample table; its schema is read from the file once.

        The order lines of a sample are one row group, which one task would bring into the
        extracts' shapes; they are dealt to all. Landed extracts have many files.
        """
        if name not in self.tables:
            rows = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            if name == "lineitem":
                rows = rows.repartition(self.spark.sparkContext.defaultParallelism, "l_suppkey")
            self.tables[name] = rows
        return self.tables[name]

    def warehouses(self, without: str | None = None) -> DataFrame:
        """Supplier and nation keys, optionally without the suppliers of one region."""
        suppliers = self.table("supplier").selectExpr("s_suppkey l_suppkey", "s_nationkey")
        if without is None:
            return suppliers
        covered = self.table("nation").join(
            self.table("region").where(F.col("r_name") != without),
            F.expr("n_regionkey = r_regionkey"),
            "left_semi",
        )
        return suppliers.join(covered, F.expr("s_nationkey = n_nationkey"), "left_semi")

    def lines(self) -> DataFrame:
        """Order lines with exact amounts and their fiscal year and period."""
        return self.table("lineitem").selectExpr(
            "l_partkey",
            "l_suppkey",
            "l_linenumber",
            "l_returnflag",
            "l_linestatus",
            "cast(l_shipdate as date) shipped",
            f"year(l_shipdate) + {YEAR_SHIFT} year",
            "month(l_shipdate) period",
            "cast(l_quantity as decimal(18,2)) quantity",
            "cast(l_extendedprice as decimal(18,2)) amount",
            "cast(cast(l_extendedprice as decimal(18,2)) * cast(l_discount as decimal(4,2))"
            f" as {MONEY_SQL}) discount",
            "cast(cast(l_extendedprice as decimal(18,2)) * cast(l_tax as decimal(4,2))"
            f" as {MONEY_SQL}) cost",
        )

    def coded_lines(self, without: str | None = None) -> DataFrame:
        """Order lines with the code of their cost centre."""
        lines = self.lines().join(self.warehouses(without), "l_suppkey")
        return lines.withColumn("code", F.expr("lpad(s_nationkey, 3, '0')"))

    def sales(self, without: str | None = None) -> DataFrame:
        """Order lines with the code, name and region key of their cost centre."""
        nations = self.table("nation").selectExpr(
            "n_nationkey s_nationkey", "n_name centre", "n_regionkey"
        )
        return self.coded_lines(without).join(nations, "s_nationkey")

    # Landed extracts

    def calendar(self) -> DataFrame:
        ordered = f"add_months(cast(o_orderdate as date), {12 * YEAR_SHIFT})"
        days = self.table("orders").selectExpr(f"{ordered} USADAT").distinct()
        return days.selectExpr("month(USADAT) PERIOD", "USADAT")

    def plant(self, without: str | None = None) -> DataFrame:
        return self.warehouses(without).selectExpr(
            "cast(l_suppkey as string) WHS", "rpad(lpad(s_nationkey, 3, '0'), 6, ' ') PLNT"
        )

    def article(self) -> DataFrame:
        """Articles with today's factor, and an outdated one for the large sizes."""
        current = self.table("part").selectExpr(
            "cast(p_partkey as string) AM01_ARTNUM",
            f"cast(p_size * 0.125BD as {FACTOR_SQL}) AM01_ARTCNVFAC2",
            """case p_type when 'STANDARD' then '1999' when 'ECONOMY' then '2999'
               when 'MEDIUM' then '3999' when 'SMALL' then '4999' when 'PROMO' then '6999'
               else '7999' end AMBCPPGRP""",
            "p_brand COMATASGP",
            f"{conform.CURRENT_EFFECTIVE_DATE} AM01_EFTDAT",
        )
        outdated = current.where("AM01_ARTCNVFAC2 > 5").selectExpr(
            "AM01_ARTNUM", f"cast(1 as {FACTOR_SQL}) AM01_ARTCNVFAC2", "AMBCPPGRP", "COMATASGP",
            "1171231 AM01_EFTDAT",
        )
        return current.unionByName(outdated)

    def adjustment_type(self) -> DataFrame:
        return self.table("region").selectExpr(
            """case r_regionkey when 0 then 'A' when 1 then 'R' when 2 then 'N'
               else concat('X', r_regionkey) end ADJTYP""",
            "cast(r_regionkey as string) ADJCLS",
        )

    def extract(self) -> DataFrame:
        posted = "date_add(shipped, 2)"
        return self.lines().selectExpr(
            "cast(l_partkey as string) RSMATL",
            "cast(l_suppkey as string) RSWHR",
            """case l_linenumber when 1 then '76' when 2 then '10' when 3 then '78'
               when 4 then '11' when 5 then '99' when 6 then '84' else '63' end `RSAVV#`""",
            "cast(date_format(shipped, 'yyyyMMdd') as int) RSDAT",
            "cast(l_partkey as string) RSART",
            f"{MATERIAL_GROUP} RSMASG",
            """case l_linenumber when 1 then '01' when 2 then '50' when 3 then 'W1'
               when 4 then 'W4' when 5 then 'W3' when 6 then '00' else '51' end RSCLS""",
            "l_returnflag RSATP",
            f"concat(year({posted}) + {YEAR_SHIFT}, lpad(month({posted}), 3, '0')) RSPERD",
            "quantity RSQTY",
            "amount RSSALTOT",
            "cost RSCOGTOT",
            "discount RSAVVTOT",
            "quantity RSSPCQTY",
            "discount RSEXAM",
            "year",
            "period",
        )

    def cube(self) -> DataFrame:
        return self.coded_lines(self.missing.get("cube")).selectExpr(
            "case when quantity < 50 then concat(code, '0000') end COSTCENTER",
            """concat(case l_linenumber when 1 then '899301' when 2 then '899301'
               when 3 then '505201' when 4 then '505401' when 5 then '305701'
               when 6 then '405506' else '999999' end, 200 + pmod(l_partkey, 600)) COSTELMNT""",
            "if(l_returnflag = 'N', 20, 10) VTYPE",
            "if(l_linestatus = 'F', 0, 1) VERSION",
            f"cast(-amount as {MONEY_SQL}) AMOUNT",
            "quantity QUANTITY",
            f"{FISCAL_KEY} FISCPER",
        )

    def profitability(self) -> DataFrame:
        """Profitability view; the value fields share out a line's cost and discount."""

        def shared(fields: tuple[str, ...], amount: str) -> list[str]:
            return [
                f"if(pmod(l_partkey, {len(fields)}) = {n}, {amount}, cast(0 as {MONEY_SQL})) {field}"
                for n, field in enumerate(fields)
            ]

        regions = self.table("region").selectExpr("r_regionkey n_regionkey", "r_name")
        volume = f"if(r_name = '{NO_VOLUME_REGION}', 0BD, quantity)"
        return self.sales(self.missing.get("profitability")).join(regions, "n_regionkey").selectExpr(
            "centre ProfitCenterText",
            "concat('P100', code) ProfitCenter",
            f"{FISCAL_KEY} FiscalYearPeriod",
            f"{MATERIAL_GROUP} MaterialAccountAssignmentGroup",
            f"cast({volume} as {MONEY_SQL}) {conform.VIEW_VOLUME}",
            f"amount {conform.VIEW_WHOLESALE[0]}",
            f"cost {conform.VIEW_WHOLESALE[1]}",
            *shared(conform.VIEW_COGS, "cost"),
            *shared(conform.VIEW_DISCOUNT, "discount"),
            "shipped",
        )

    def snapshots(self) -> DataFrame:
        """Four snapshots per period: the figures known by the end of each week.

        Weeks are summed first; only those sums are repeated for the later snapshots.
        """
        week = F.expr("cast(least(ceil(dayofmonth(shipped) / 7), 4) as int)")
        weekly = conform.conform_profitability(
            self.profitability().withColumn("week", week), "week"
        )
        figures = ("Volume", "Wholesale", "COGS", "DISC", "NSI")
        names = {"NAME": "ProfitCenterName", "CODE": "ProfitCenterCode"}
        return (
            weekly.withColumn("Number", F.explode(F.sequence("week", F.lit(4))))
            .withColumnsRenamed(names)
            .groupBy("Number", *names.values(), "YEAR", "PERIOD")
            .agg(*[F.sum(c).cast(MONEY).alias(c) for c in figures])
        )

    def _export(self, figures: dict[str, str]) -> DataFrame:
        """An exported report: one line per cost centre and one of totals per period."""
        sold = self.sales(self.missing.get("exports")).where("l_returnflag <> 'N'")
        centres = sold.groupBy("year", "period", "centre", "code").agg(
            *[F.expr(f"sum({sql})").alias(name) for name, sql in figures.items()]
        )
        totals = centres.groupBy("year", "period").agg(
            *[F.sum(f"`{name}`").alias(name) for name in figures]
        )
        lines = centres.unionByName(
            totals.withColumns({"centre": F.lit("Totals"), "code": F.lit(None).cast("string")})
        )
        headers = {
            "year": "YEAR", "period": "PERIOD",
            "centre": "Act.Cost.Cntr", "code": "Act.Cost.Cntr.host.code",
        }
        return lines.withColumnsRenamed(headers)

    def gl_export(self) -> DataFrame:
        return self._export(
            {
                "Total.Gross.Vol": "quantity",
                "NSI.Simple": "amount - discount",
                "[Cona.NSI.Simple]$Cona_Sales": "amount",
                "NSI": "amount - cost",
                "COGS.Simple": "cost",
            }
        )

    def physical_export(self) -> DataFrame:
        return self._export({"Vol.Gross.Sales.Volume": "quantity"})

    def summary(self) -> DataFrame:
        """Sales summary; some part types are the products it leaves out."""
        parts = self.table("part").selectExpr(
            "p_partkey l_partkey",
            "p_size",
            """case p_type when 'PROMO' then 'OTH CUPS' when 'SMALL' then 'OTH CO2 FULL '
               when 'LARGE' then 'OTH STRAWS  ' else p_name end PRDDESC""",
        )
        covered = self.warehouses(self.missing.get("summary"))
        return self.lines().join(covered, "l_suppkey", "left_semi").join(
            parts, "l_partkey"
        ).selectExpr(
            "cast(l_suppkey as string) RSWHR",
            "PRDDESC",
            f"cast(if(l_returnflag = 'N', 0BD, quantity) as {MONEY_SQL}) VOLPHYBCPP",
            f"cast(quantity * p_size as {MONEY_SQL}) VOLGLUBCPP",
            f"cast(amount - discount as {MONEY_SQL}) NSISM",
            "cost COGBCPP",
            "year fiscal_year",
            "period PERIOD",
        )

    # Conformed ledgers

    def ledger(self, name: str) -> DataFrame:
        """One conformed ledger."""
        if name == "profitability":
            return conform.conform_profitability(self.profitability())
        if name == "extract":
            return conform.conform_extract(
                self.extract(), self.plant(self.missing.get("extract")), self.article(),
                self.adjustment_type(),
            )
        if name == "cube":
            return conform.conform_cube(self.cube(), default_account_map(self.spark))
        if name == "gl_export":
            return conform.conform_gl_export(self.gl_export())
        if name == "physical_export":
            return conform.conform_physical_export(self.physical_export())
        if name == "summary":
            return conform.conform_summary(self.summary(), self.plant())
        raise KeyError(name)

    def ledgers(self, *names: str) -> Ledgers:
        """The named ledgers (all by default)."""
        wanted = names or Ledgers._fields
        return Ledgers(**{name: self.ledger(name) for name in wanted})
