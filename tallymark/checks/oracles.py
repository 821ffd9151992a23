"""SQL twins of the registered queries, written against the sample tables.

They state the expected figures directly (which lines count and with what sign),
not the extract shapes in between, so that a wrong mapping shows as a difference.
"""

from __future__ import annotations

import re

ORACLES: dict[str, str] = {}

LINES = """
lines as (
  select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_linestatus,
         cast(l_shipdate as date) shipped,
         cast(year(l_shipdate) + 19 as integer) y, cast(month(l_shipdate) as integer) p,
         cast(l_quantity as decimal(18,2)) q,
         cast(l_extendedprice as decimal(18,2)) amt,
         cast(l_extendedprice as decimal(18,2)) * cast(l_discount as decimal(4,2)) disc,
         cast(l_extendedprice as decimal(18,2)) * cast(l_tax as decimal(4,2)) cost
  from lineitem)"""

CENTRES = """
centres as (
  select s_suppkey, lpad(cast(s_nationkey as varchar), 3, '0') code,
         n_name centre, r_name region
  from supplier join nation on s_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey)"""

SALES = """
sales as (select * from lines join centres on l_suppkey = s_suppkey)"""

VIEW = """
copa as (
  select y, p, code, centre name,
         sum(case when region = 'AMERICA' then 0 else q end) volume,
         sum(amt) + sum(cost) wholesale, sum(cost) cogs, sum(disc) disc,
         sum(amt) + sum(cost) - sum(disc) nsi
  from sales where region <> 'AFRICA' and l_returnflag in ('A', 'R')
  group by y, p, code, centre)"""

EXTRACT = """
senior as (
  select y, p, code, sum(q) volume,
         cast(sum(q * p_size) as decimal(24,2)) * 0.125 glunit,
         sum(amt) - sum(case when l_linenumber = 2 then disc else 0 end) nsiavv,
         sum(amt) - sum(disc) nsiexam, sum(cost) cogs
  from sales join part on l_partkey = p_partkey
  where region <> 'MIDDLE EAST' and l_returnflag in ('A', 'R')
    and l_linenumber in (1, 2, 3, 5)
  group by y, p, code)"""

# The cost elements of each class, held apart from the library's own.
VOLUME_ELEMENTS = """
899301253 899301254 899301256 899301260 899301261 899301262 899301265 899301266 899301267
899301268 899301269 899301275 899301276 899301776 899301777 899301400 899301407 899301408
899301420 899301427 899301429 899301431 899301433 899301435 899301451 899301453 899301455
899301459 899301461 899301462 899301463 899301464 899301471 899301478 899301480 899301481
899301482 899301483 899301484 899301485 899301486 899301487 899301501 899301503 899301505
899301507 899301517 899301518 899301520 899301521 899301522 899301524 899301525 899301526
899301527 899301530 899301552 899301553 899301557 899301558 899301559 899301560 899301562
899301563 899301565 899301566 899301568 899301590 899301600 899301603 899301608 899301614
899301619 899301620 899301624 899301628 899301629 899301630 899301202 899301204 899301205
899301206 899301207 899301208 899301211 899301212 899301230 899301231 899301233 899301234
899301237 899301245 899301307 899301308 899301310 899301316 899301318 899301320 899301301
899301257 899301259 899301610 899301502 899301465 899301607 899301606 899301623 899301601
""".split()

COGS_ELEMENTS = """
505201202 505201204 505201205 505201206 505201207 505201208 505201211 505201212 505201230
505201231 505201233 505201234 505201237 505201245 505201253 505201254 505201256 505201260
505201261 505201262 505201265 505201266 505201267 505201268 505201269 505201275 505201276
505201301 505201307 505201308 505201310 505201316 505201318 505201320 505201400 505201407
505201408 505201420 505201427 505201429 505201431 505201433 505201435 505201451 505201453
505201455 505201459 505201461 505201462 505201463 505201464 505201471 505201478 505201480
505201481 505201482 505201483 505201484 505201485 505201486 505201487 505201501 505201503
505201505 505201507 505201517 505201518 505201520 505201521 505201522 505201524 505201525
505201526 505201527 505201530 505201553 505201558 505201559 505201560 505201562 505201563
505201565 505201566 505201568 505201590 505201600 505201603 505201608 505201614 505201619
505201620 505201624 505201628 505201629 505201630 505201776 505201777 505201257 505201259
505201610 505201502 505401502 505201552 505201465 505201310
""".split()

NSI_ELEMENTS = """
305701202 305701204 305701205 305701206 305701207 305701208 305701211 305701212 305701230
305701231 305701233 305701234 305701237 305701245 305701253 305701254 305701256 305701260
305701261 305701262 305701265 305701266 305701267 305701268 305701269 305701275 305701276
305701301 305701307 305701308 305701310 305701316 305701318 305701320 305701400 305701407
305701408 305701420 305701427 305701429 305701431 305701433 305701435 305701451 305701453
305701455 305701459 305701461 305701462 305701463 305701464 305701471 305701478 305701480
305701481 305701482 305701483 305701484 305701485 305701486 305701487 305701501 305701503
305701505 305701507 305701517 305701518 305701520 305701521 305701522 305701524 305701525
305701526 305701527 305701530 305701553 305701558 305701559 305701560 305701562 305701563
305701565 305701566 305701568 305701590 305701600 305701603 305701608 305701614 305701619
305701620 305701624 305701628 305701629 305701630 405506202 405506204 405506205 405506206
405506207 405506208 405506211 405506212 405506230 405506231 405506233 405506234 405506237
405506245 405506253 405506254 405506256 405506260 405506261 405506262 405506265 405506266
405506267 405506268 405506269 405506275 405506301 405506307 405506308 405506310 405506316
405506318 405506320 405506400 405506407 405506408 405506420 405506427 405506429 405506431
405506433 405506435 405506451 405506453 405506455 405506459 405506461 405506462 405506463
405506464 405506471 405506478 405506480 405506481 405506482 405506483 405506484 405506485
405506486 405506487 405506501 405506503 405506505 405506507 405506517 405506518 405506520
405506521 405506522 405506524 405506525 405506526 405506527 405506530 405506553 405506558
405506559 405506560 405506562 405506563 405506565 405506566 405506568 405506590 405506600
405506603 405506608 405506614 405506619 405506620 405506624 405506628 405506629 405506630
405506257 405506259 405506502 405506610 305701610 305701502 305701259 305701257 305701552
305701465
""".split()

ELEMENTS = "elements(element, class) as (values {})".format(
    ", ".join(
        f"('{element}', '{kind}')"
        for kind, elements in (
            ("volume", VOLUME_ELEMENTS), ("cogs", COGS_ELEMENTS), ("nsi", NSI_ELEMENTS)
        )
        for element in sorted(set(elements))
    )
)

POSTINGS = """
postings as (
  select y, p, code, class, -amt amt, q
  from sales join elements on element =
       case l_linenumber when 1 then '899301' when 2 then '899301' when 3 then '505201'
                         when 4 then '505401' when 5 then '305701' when 6 then '405506'
                         else '999999' end || cast(200 + l_partkey % 600 as varchar)
  where region <> 'AMERICA' and q < 50 and l_returnflag <> 'N' and l_linestatus = 'F')"""

CUBE = """
bw as (
  select y, p, code, sum(case when class = 'volume' then amt end) volume,
         sum(case when class = 'cogs' then amt end) cogs,
         sum(case when class = 'nsi' then amt end) nsi
  from postings group by y, p, code)"""

EXPORT = """
mm as (
  select y, p, code, centre name, sum(q) volume, sum(amt - disc) simple, sum(amt) cona,
         sum(amt - cost) nsi, sum(cost) cogs
  from sales where region <> 'EUROPE' and l_returnflag <> 'N'
  group by y, p, code, centre)"""

SUMMARY = """
warehouses as (
  select y, p, code, l_suppkey,
         sum(case when l_returnflag = 'N' then 0 else q end) volume,
         sum(q * p_size) glunit, sum(amt - disc) nsi, sum(cost) cogs
  from sales join part on l_partkey = p_partkey
  where p_type not in ('PROMO', 'SMALL', 'LARGE')
  group by y, p, code, l_suppkey, region
  having region <> 'ASIA' and sum(case when l_returnflag = 'N' then 0 else q end) <> 0),
zr as (
  select y, p, code, sum(volume) volume, sum(glunit) glunit, sum(nsi) nsi, sum(cogs) cogs
  from warehouses group by y, p, code)"""

INDEX = """
idx as (
  select y, p, code, name, 'CONA' sys from copa where y * 100 + p > 201804 or volume <> 0
  union all
  select y, p, code, name, 'Legacy' sys from mm
  where (y, p, code) in (select (y, p, code) from senior)
    and (y, p, code) not in (select (y, p, code) from copa))"""

BASE = (LINES, CENTRES, SALES)
LEDGERS = (*BASE, VIEW, EXTRACT, ELEMENTS, POSTINGS, CUBE, EXPORT, SUMMARY, INDEX)


def whole(*ctes: str) -> tuple[str, ...]:
    """The same tables without the region that one system lacks."""
    return tuple(re.sub(r"region <> '[A-Z ]+'", "true", cte) for cte in ctes)


def with_ctes(ctes: tuple[str, ...], select: str) -> str:
    return "with " + ",".join(ctes) + "\n" + select.strip()


def oracle(name: str, select: str, *ctes: str) -> None:
    ORACLES[name] = with_ctes(ctes, select) if ctes else select.strip()


def double(**columns: str) -> str:
    """Select-list items cast to double under the given names."""
    return ", ".join(f'cast({sql} as double) as "{name}"' for name, sql in columns.items())


def versus(base: str, other: str, fallback: str, op: str = "-") -> str:
    return (
        f"case when {base} is null or {base} = 0 then {fallback} {op} {other}"
        f" else {base} {op} {other} end"
    )


def stamp(flag: str = "YES") -> str:
    return f"""cast(date '2020-11-30' - date '1970-01-01' as integer) as "DATE",
        p as "PERIOD", y as "YEAR", '{flag}' as "PERIODEND\""""


KEY = 'y as "YEAR", p as "PERIOD", code as "CODE"'

# Sources

_TABLE_NAME = """case when y = 2020 and p = 11 then 'KOEXTT'
            else 'KOEXT' || substr(cast(y as varchar), 3, 2)
                 || lpad(cast(p as varchar), 2, '0') end table_name"""

oracle(
    "scan_prune_partition",
    f"""
select y as year, p as period, count(*) n_lines, cast(sum(q) as double) rsqty, {_TABLE_NAME}
from lines where y = 2020 and p in (10, 11) group by y, p""",
    LINES,
)

oracle(
    "extract_table_names",
    f"""select y as year, p as period, count(*) n_lines, {_TABLE_NAME} from lines group by y, p""",
    LINES,
)

oracle(
    "scan_prune_keys",
    """
select cast(y as varchar) || lpad(cast(p as varchar), 3, '0') as "FISCPER",
       case l_returnflag when 'N' then 20 else 10 end as "VTYPE",
       cast(sum(-amt) as double) as "AMOUNT"
from sales where y = 2020 and p in (10, 11) group by y, p, 2""",
    *BASE,
)

oracle(
    "decode_work_area",
    """
select cast(l_orderkey as double) as "ORDERKEY", cast(l_linenumber as double) as "LINE",
       l_returnflag as "FLAG",
       case when l_returnflag = 'R' then -l_quantity else l_quantity end as "QTY",
       l_extendedprice as "PRICE",
       case when l_linenumber in (6, 7) then 0 else l_tax end as "RATE"
from lineitem""",
)

oracle(
    "cube_slice",
    """
select cast(y as varchar) || lpad(cast(p as varchar), 3, '0') as "FISCPER",
       code || '0000' as "COSTCENTER", cast(sum(-amt) as double) as "AMOUNT",
       cast(sum(q) as double) as "QUANTITY"
from sales
where q < 50 and l_returnflag <> 'N' and l_linestatus = 'F'
group by y, p, code""",
    *BASE,
)

oracle(
    "report_clean",
    f"""
select y as "YEAR", p as "PERIOD", name as "ACTCOSTCNTR", code as "ACTCOSTCNTRHOSTCODE",
  {double(TOTALGROSSVOL="volume", NSISIMPLE="simple", CONANSISIMPLE="cona", MMNSI="nsi",
          COGSSIMPLE="cogs")}
from mm""",
    *whole(*BASE, EXPORT),
)

oracle(
    "fiscal_lookup",
    """
with days as (select distinct cast(o_orderdate as date) + interval 228 month as d from orders),
shipped as (select cast(l_shipdate as date) + interval 228 month as d from lineitem)
select cast(year(s.d) as integer) as "YEAR", cast(month(days.d) as integer) as "PERIOD",
       count(*) n_lines
from shipped s left join days on s.d = days.d
group by 1, 2""",
)

oracle(
    "prior_period",
    """
with days as (select distinct cast(cast(o_orderdate as date) + interval 228 month as date) d
              from orders),
keyed as (select d, cast(year(d) as integer) y, cast(month(d) as integer) p,
                 cast(year(d - to_months(1)) as integer) py,
                 cast(month(date_trunc('month', d) - to_months(1)) as integer) pp from days)
select cast(d - date '1970-01-01' as integer) usadat, y as year, p as period,
       py as prior_year, pp as prior_period,
       cast(y as varchar) || '0' || lpad(cast(p as varchar), 2, '0') period_key,
       cast(py as varchar) || '0' || lpad(cast(pp as varchar), 2, '0') prior_key,
       strftime(d, '%Y%m%d') day_stamp
from keyed""",
)

oracle(
    "excel_serial_dates",
    """
select cast(cast(o_orderdate as date) - date '1899-12-30' as integer) serial,
       count(*) n_orders, cast(cast(o_orderdate as date) - date '1970-01-01' as integer) as "day"
from orders group by 1, 3""",
)

oracle(
    "scalar_functions",
    """
select p_partkey, substr(p_name, 2, 3) name_part, cast(length(p_name) as integer) name_length,
       p_brand brand, upper(p_type) type_upper,
       cast(replace(p_brand, 'Brand#', '') as integer) brand_number,
       cast(null as integer) no_number, lpad(cast(p_size as varchar), 3, '0') centre_code,
       cast(floor(cast(p_retailprice as decimal(18,2)) * 10 / 7) / 10 as double) price_floor,
       cast(round(cast(p_retailprice as decimal(18,2)) * 0.125, 2) as double) price_rounded,
       abs(p_size - 25) size_distance,
       case when p_size in (1, 10, 11) then 1 else 0 end small_lot,
       case when p_size > 25 then p_size else 0 end size_filled
from part""",
)

_PAGE = """
select cast(cast(o_orderdate as date) - date '1970-01-01' as integer) o_orderdate,
       o_orderkey, o_orderpriority
from orders order by o_orderdate, o_orderkey {}"""
oracle(
    "row_window_ties",
    """
select o_orderpriority, o_orderkey from orders
order by o_orderpriority, o_orderkey limit 700 offset 300""",
)
oracle("row_window", _PAGE.format("limit 500 offset 200"))
oracle("row_window_rest", _PAGE.format("offset 200"))

# Conformed ledgers

oracle(
    "account_class_sums",
    f"""select {KEY}, {double(Volume="volume", COGS="cogs", NSI="nsi")} from bw""",
    *whole(*BASE, ELEMENTS, POSTINGS, CUBE),
)

oracle(
    "account_class_outer",
    f"""
select cast(y as varchar) || lpad(cast(p as varchar), 3, '0') as "FISCPER",
       code || '0000' as "CostCenter", {double(Volume="volume", COGS="cogs", NSI="nsi")}
from (select y, p, code, sum(amt) volume from postings where class = 'volume' group by 1, 2, 3) v
full join (select y, p, code, sum(amt) cogs from postings where class = 'cogs' group by 1, 2, 3) c
  using (y, p, code)
full join (select y, p, code, sum(amt) nsi from postings where class = 'nsi' group by 1, 2, 3) n
  using (y, p, code)""",
    *whole(*BASE, ELEMENTS, POSTINGS),
)

oracle(
    "star_rollup",
    f"""
select {KEY}, {double(VOLUMEPHYSICAL="volume", VOLUMEGLUNIT="glunit", NSIAVV="nsiavv",
                      NSIRSEXAM="nsiexam", COGS="cogs")}
from senior""",
    *whole(*BASE, EXTRACT),
)

oracle(
    "indicator_measures",
    f"""
select {KEY}, {double(
    VOLUMEPHYSICAL="sum(q) filter (l_returnflag <> 'N')",
    VOLUMEGLUNIT="cast(sum(q * p_size) filter (p_type <> 'LARGE') as decimal(24,2)) * 0.125",
    NSI="sum(amt - case when l_linenumber in (2, 4, 7) then disc else 0 end)"
        " filter (l_returnflag <> 'N')",
    COGS="sum(case when l_linenumber in (1, 3, 6) then disc else 0 end)"
         " filter (l_returnflag <> 'N')")}
from sales join part on l_partkey = p_partkey
group by y, p, code
having count(*) filter (l_returnflag <> 'N') > 0""",
    *BASE,
)

oracle(
    "copa_net_measures",
    f"""
select {KEY}, name as "NAME", {double(Volume="volume", Wholesale="wholesale", COGS="cogs",
                                      DISC="disc", NSI="nsi")}
from copa""",
    *whole(*BASE, VIEW),
)

_ZR = double(ZRVOLUME="volume", ZRGLVOLUME="glunit", ZRNSI="nsi", ZRCOGS="cogs")
oracle(
    "summary_rollup",
    f"""select {KEY}, cast(l_suppkey as varchar) as "RSWHR", {_ZR} from warehouses""",
    *whole(*BASE, SUMMARY),
)
oracle("summary_by_plant", f"select {KEY}, {_ZR} from zr", *whole(*BASE, SUMMARY))

oracle(
    "physical_export_rows",
    f"""select {KEY}, name as "NAME", {double(VolGrossSalesVolume="volume")} from mm""",
    *whole(*BASE, EXPORT),
)

oracle(
    "union_reaggregate",
    f"""
select {KEY}, {double(volume="sum(volume)", cogs="sum(cogs)")}
from (select y, p, code, volume, cogs from senior
      union all select y, p, code, volume, cogs from zr)
group by y, p, code order by 1, 2, 3""",
    *whole(*BASE, EXTRACT, SUMMARY),
)

# Control totals and snapshots

STRAYS = """
posted as (
  select y, p, cast(year(shipped + 2) + 19 as varchar)
         || lpad(cast(month(shipped + 2) as varchar), 3, '0') k, sum(q) q
  from lines where l_returnflag <> 'N' group by y, p, k),
strays as (
  select y, p, k, q, k <> cast(y as varchar) || lpad(cast(p as varchar), 3, '0') stray
  from posted)"""

CONTROL = """
control as (
  select y, p, t.total, coalesce(n, 0) n, strayed,
         t.total - case when n > 1 then coalesce(strayed, 0) else 0 end adjusted
  from (select y, p, sum(volume) total from senior group by y, p) t
  left join (select y, p, count(*) n, sum(q) filter (stray) strayed from strays group by y, p)
    using (y, p))"""

SNAPSHOTS = """
weeks as (select unnest([1, 2, 3, 4]) n),
snaps as (
  select n, y, p, code, centre name, sum(case when region = 'AMERICA' then 0 else q end) volume,
         sum(amt) + sum(cost) wholesale, sum(cost) cogs, sum(disc) disc,
         sum(amt) + sum(cost) - sum(disc) nsi
  from sales join weeks on n >= least((day(shipped) + 6) // 7, 4)
  where region <> 'AFRICA' and l_returnflag <> 'N'
  group by n, y, p, code, centre),
scored as (
  select y, p, snaps.n, abs(sum(volume) - any_value(adjusted)) dist
  from snaps join control using (y, p) group by y, p, snaps.n),
nearest as (
  select y, p, n, dist
  from scored qualify row_number() over (partition by y, p order by dist, n) = 1)"""

oracle(
    "stray_period_volume",
    """
select y as "YEAR", p as "PERIOD", k as "RSPERD", cast(q as double) as "RSQTY", stray as "STRAY"
from strays""",
    LINES, STRAYS,
)

oracle(
    "control_total",
    f"""
select y as "YEAR", p as "PERIOD", cast(n as bigint) as "PERIODKEYS",
       {double(TOTALVOLUME="total", STRAYVOLUME="strayed", CONTROLTOTAL="adjusted")}
from control""",
    *whole(*BASE, EXTRACT, STRAYS, CONTROL),
)

oracle(
    "nearest_snapshot_number",
    """
select y as "YEAR", p as "PERIOD", n as "Number", cast(dist as double) as "DISTANCE"
from nearest""",
    *whole(*BASE, EXTRACT, STRAYS, CONTROL, SNAPSHOTS),
)

oracle(
    "nearest_snapshot",
    f"""
select n as "Number", y as "YEAR", p as "PERIOD", name as "ProfitCenterName",
       code as "ProfitCenterCode", {double(Volume="volume", Wholesale="wholesale", COGS="cogs",
                                           DISC="disc", NSI="nsi")}
from snaps join nearest using (y, p, n)""",
    *whole(*BASE, EXTRACT, STRAYS, CONTROL, SNAPSHOTS),
)

# Alignment

oracle(
    "system_index",
    f"""select {KEY}, name as "NAME", sys as "System" from idx""",
    *BASE, VIEW, EXTRACT, EXPORT, INDEX,
)

oracle(
    "code_membership",
    f"""
with_view as (select y, p, code from copa), with_extract as (select y, p, code from senior),
only_extract as (select * from with_extract except select * from with_view),
found as (
  select *, 'extract only' found from only_extract
  union all
  select *, 'view only' from (select * from with_view except select * from with_extract)
  union all
  select y, p, code, 'extract only, named' from mm join only_extract using (y, p, code))
select {KEY}, found from found""".replace("with_view as (select y", ", with_view as (select y", 1),
    *BASE, VIEW, EXTRACT, EXPORT,
)

ALIGNED = """
aligned as (
  select y, p, code, copa.volume v, senior.volume e, bw.volume c
  from copa full join senior using (y, p, code) full join bw using (y, p, code))"""

oracle(
    "full_outer_align",
    f"""
select {KEY}, {double(view_volume="coalesce(v, 0)", extract_volume="coalesce(e, 0)",
                      cube_volume="c")},
       case when v is null then 1 else 0 end no_view
from aligned""",
    *BASE, VIEW, EXTRACT, ELEMENTS, POSTINGS, CUBE, ALIGNED,
)

oracle(
    "variance_fallback",
    f"""
select {KEY}, {double(view_volume="v", extract_volume="e", cube_volume="c", plain_var="v - e",
                      fallback_var=versus("v", "c", "e"), own_fallback_var=versus("v", "e", "e"),
                      opposite_var=versus("v", "c", "e", "+"))}
from aligned""",
    *BASE, VIEW, EXTRACT, ELEMENTS, POSTINGS, CUBE, ALIGNED,
)

# Reports


def zero(**columns: str) -> str:
    return double(**{name: f"coalesce({sql}, 0)" for name, sql in columns.items()})


def physical_figures(ko: str, mm: str) -> str:
    """Figures of the physical report; ``ko`` and ``mm`` say how an absent one counts."""
    return ", ".join(
        [
            double(
                HANAVOLUME="h", KOEXTTVOLUME=ko, KOEXTTVAR=versus("h", ko, ko),
                MMVOLUME=mm, MMVAR=versus("h", mm, ko),
            ),
            zero(ZRVOLUME="z", ZRVAR=versus("h", "z", ko)),
        ]
    )


def gl_figures() -> str:
    return zero(
        MMVOLUME="m", VOLUMEGLUNIT="k", MMVAR="k - m", BWVOLUME="b", BWVAR="k + b",
        ZRGLVOLUME="z", ZRVAR="k - z",
    )


def nsi_figures(avv: str, simple: str, cona: str, nsi: str) -> str:
    return zero(
        HANANSI="h", KOEXTTAVV=avv, KOEXTTAVVVAR=versus("h", avv, avv), KOEXTTRSEXAM="x",
        KOEXTTRSEXAMVAR=versus("h", "x", "x"), NSISimple=simple, CONANSISimple=cona, MMNSI=nsi,
        MMSimpleVAR=versus("h", simple, "x"), MMCONAVAR=versus("h", cona, "x"),
        MMNSIVAR=versus("h", nsi, "x"), BWNSI="b", BWVAR=versus("h", "b", "x", "+"), ZRNSI="z",
        ZRVAR=versus("h", "z", "x"),
    )


def cogs_figures(ko: str, mm: str) -> str:
    return zero(
        HANACOGS="h", KOEXTTCOGS=ko, KOEXTTVAR=versus("h", ko, ko), MMCOGS=mm,
        MMVAR=versus("h", mm, ko), BWCOGS="b", BWVAR=versus("h", "b", ko), ZRCOGS="z",
        ZRVAR=versus("h", "z", ko),
    )


PHYSICAL_SIDES = "h.volume h, s.volume k, m.volume m, r.volume z"
GL_SIDES = "m.name gl_name, m.volume m, s.glunit k, b.volume b, r.glunit z"
NSI_SIDES = "h.nsi h, s.nsiavv a, s.nsiexam x, m.simple s1, m.cona s2, m.nsi s3, b.nsi b, r.nsi z"
COGS_SIDES = "h.cogs h, s.cogs k, m.cogs m, b.cogs b, r.cogs z"

FILLED = {
    "physical": physical_figures("coalesce(k, 0)", "coalesce(m, 0)"),
    "gl": gl_figures(),
    "nsi": nsi_figures("coalesce(a, 0)", "coalesce(s1, 0)", "coalesce(s2, 0)", "coalesce(s3, 0)"),
    "cogs": cogs_figures("coalesce(k, 0)", "coalesce(m, 0)"),
}
UNFILLED = {
    "physical": physical_figures("k", "m"),
    "gl": gl_figures(),
    "nsi": nsi_figures("a", "s1", "s2", "s3"),
    "cogs": cogs_figures("k", "m"),
}
SIDES = {
    "physical": PHYSICAL_SIDES, "gl": GL_SIDES, "nsi": NSI_SIDES, "cogs": COGS_SIDES,
}


def indexed(name: str, view: str = "copa", index: str = "idx") -> str:
    """The index's codes with every ledger's figures for one report."""
    return f"""
select y, p, code, i.name, sys, {SIDES[name]}
from {index} i left join {view} h using (y, p, code) left join senior s using (y, p, code)
left join mm m using (y, p, code) left join bw b using (y, p, code)
left join zr r using (y, p, code)"""


def report_sql(name: str, flag: str, view: str = "copa", index: str = "idx") -> str:
    named = "where gl_name is not null" if name == "gl" else ""
    return f"""
select code as "CODE", name as "COSTCENTER", {FILLED[name]}, {stamp(flag)}, sys as "System"
from ({indexed(name, view, index)}) {named}"""


def old_report_sql(name: str) -> str:
    """Every code of the ledgers the report reads; a variance exists where its side's did."""
    ledgers = {
        "physical": ("copa h", "senior s", "mm m", "zr r"),
        "gl": ("mm m", "senior s", "bw b", "zr r"),
        "nsi": ("copa h", "senior s", "mm m", "bw b", "zr r"),
        "cogs": ("copa h", "senior s", "mm m", "bw b", "zr r"),
    }[name]
    first, *others = ledgers
    joins = "".join(f"\nfull join {ledger} using (y, p, code)" for ledger in others)
    cost_centre = "m.name" if name == "gl" else "h.name"
    named = "where name is not null" if name == "gl" else ""
    return f"""
select code as "CODE", name as "COSTCENTER", {UNFILLED[name]}, {stamp()}
from (select y, p, code, {cost_centre} as name, {SIDES[name]} from {first}{joins}) {named}"""


for _name in SIDES:
    oracle(f"report_{_name}", report_sql(_name, "YES"), *LEDGERS)
    oracle(f"report_{_name}_old", old_report_sql(_name), *LEDGERS)

OPENED = """
opened as (
  select y, p, code, name, volume, nsi, cogs from snaps join nearest using (y, p, n)),
opened_idx as (
  select y, p, code, name, 'CONA' sys from opened where y * 100 + p > 201804 or volume <> 0
  union all
  select y, p, code, name, 'Legacy' sys from mm
  where (y, p, code) in (select (y, p, code) from senior)
    and (y, p, code) not in (select (y, p, code) from opened))"""

for _name in SIDES:
    oracle(
        f"period_pair_{_name}",
        report_sql(_name, "YES")
        + "\nunion all\n"
        + report_sql(_name, "NO", "opened", "opened_idx").strip(),
        *LEDGERS, STRAYS, CONTROL, SNAPSHOTS, OPENED,
    )

# History

oracle(
    "latest_flag",
    """
select y as "YEAR", p as "PERIOD", code as "CODE",
       cast(shipped - date '1970-01-01' as integer) as "DATE", l_linenumber as "TIMESRANTODAY",
       cast(q as double) as "VOLUME",
       case when shipped = last_day and l_linenumber =
                 max(case when shipped = last_day then l_linenumber end)
                 over (partition by y, p)
            then 'YES' else 'NO' end as "MOSTRECENT"
from (select y, p, code, shipped, l_linenumber, sum(q) q,
             max(shipped) over (partition by y, p) last_day
      from sales group by y, p, code, shipped, l_linenumber)""",
    *BASE,
)

BATCH = f"""
batch as (
  select code, name, {{figures}}, date '2020-11-30' d, p, y, 'YES' flag, sys
  from ({indexed("physical")})),
stored as (
  select code, name,
         cast(h as decimal(24,3))
         + case when p between 7 and 9 and code < '010' then 0.01 when p = 10 then 0.001
                else 0 end h,
         k, kv, m, mv, z, zv, d - case when p between 4 and 6 then 1 else 0 end d, p, y, flag, sys,
         case when p between 7 and 9 then 2 else 1 end run
  from batch where p < 11 or (p = 11 and code < '010')),
unseen as (
  select code, name, h, k, kv, m, mv, z, zv, d, p, y, flag, sys from batch
  except
  select code, name, round(h, 2), k, kv, m, mv, z, zv, d, p, y, flag, sys from stored),
changed as (select distinct y, p from unseen)""".replace(
    "{figures}",
    """coalesce(round(h, 2), 0) h, coalesce(k, 0) k,
         case when h is null or h = 0 then 0 else h - coalesce(k, 0) end kv,
         coalesce(m, 0) m,
         case when h is null or h = 0 then coalesce(k, 0) else h end - coalesce(m, 0) mv,
         coalesce(z, 0) z,
         case when z is null then 0
              when h is null or h = 0 then coalesce(k, 0) - z else h - z end zv""",
)

oracle(
    "batch_is_new",
    """
select y as "YEAR", p as "PERIOD", cast(count(u.code) as bigint) n_unseen,
       case when count(u.code) > 0 then 'YES' else 'NO' end is_new
from (select distinct y, p from batch) left join unseen u using (y, p)
group by y, p""",
    *LEDGERS, BATCH,
)

_HISTORY = """
select code as "CODE", name as "COSTCENTER", cast(h as double) as "HANAVOLUME",
       cast(k as double) as "KOEXTTVOLUME", cast(kv as double) as "KOEXTTVAR",
       cast(m as double) as "MMVOLUME", cast(mv as double) as "MMVAR",
       cast(z as double) as "ZRVOLUME", cast(zv as double) as "ZRVAR",
       cast(d - date '1970-01-01' as integer) as "DATE", p as "PERIOD", y as "YEAR",
       flag as "PERIODEND", sys as "SYSTEM", recent as "MOSTRECENT",
       cast(run as integer) as "TIMESRANTODAY", '2020-11-30 09:15:00' as "DATETIME"
from (
  select s.*, case when c.p is null then 'YES' else 'NO' end recent
  from stored s left join changed c on s.y = c.y and s.p = c.p
  union all
  select b.* replace (cast(h as decimal(24,3)) as h),
         case when p between 7 and 9 then 3 when p = 11 then 2 else 1 end run, 'YES'
  from batch b where (y, p) in (select (y, p) from changed))"""

oracle("history_append_changed", _HISTORY, *LEDGERS, BATCH)
oracle("history_append_same", _HISTORY, *LEDGERS, BATCH)

oracle(
    "distinct_merge",
    """
rows as (
  select y, p, code, l_returnflag flag, sum(q) q,
         date '1899-12-30' + p + 43100 + case when l_returnflag = 'R' then 1 else 0 end d
  from sales group by y, p, code, l_returnflag),
merged as (select distinct y, p, code, q, cast(d as date) d from rows)
select y as "YEAR", p as "PERIOD", code as "CODE", cast(q as double) as "VOLUME",
       cast(d - date '1970-01-01' as integer) as "DATE", 1 as "TIMESRANTODAY",
       case when d = max(d) over (partition by y, p) then 'YES' else 'NO' end as "MOSTRECENT"
from merged""".replace("rows as", ", rows as", 1),
    *BASE,
)

oracle(
    "audit_counts",
    """
select 'profitability' as "TABLE_NAME", count(*) as "N_ROWS", 9 as "N_COLUMNS" from copa
union all select 'extract', count(*), 8 from senior
union all select 'cube', count(*), 6 from bw
union all select 'gl_export', count(*), 9 from mm
union all select 'physical_export', count(*), 5 from mm
union all select 'summary', count(*), 7 from zr""",
    *whole(*LEDGERS),
)

# Landed and stored forms of the same figures

oracle(
    "dated_extract_periods",
    """
select y as year, p as period, case l_returnflag when 'A' then '11' when 'R' then '18' else '30' end as "RSMASG",
       count(*) n_lines, cast(sum(q) as double) rsqty,
       case when p > 9 then cast(sum(disc) as double) end rsexam
from lines where y = 2020 and p in (9, 10, 11) group by 1, 2, 3""",
    LINES,
)

oracle(
    "export_period_ends",
    f"""
with_flag as (select *, case when y * 100 + p < 202011 then 1 else 2 end f from mm)
select {KEY}, name as "NAME",
  {double(TotalGrossVol="f * volume", NSISimple="f * simple", CONANSISimple="f * cona", MMNSI="f * nsi",
          COGSSimple="f * cogs")}
from with_flag""".replace("with_flag as", ", with_flag as", 1),
    *whole(*BASE, EXPORT),
)

oracle(
    "work_area_rejects",
    """
with w as (
  select l_orderkey, l_linenumber,
         printf('%.2f', l_quantity) q, format('{:,.2f}', l_extendedprice) price, printf('%.2f', l_tax) tax
  from lineitem)
select l_orderkey, l_linenumber, 'QTY' as "FIELD", repeat('9', 31) as "TEXT", 'too large' as "REASON"
from w where l_linenumber = 5
union all select l_orderkey, l_linenumber, 'RATE', 'n/a', 'malformed' from w where l_linenumber = 7
union all select l_orderkey, l_linenumber, 'PRICE', null, 'missing' from w where l_linenumber = 1
union all select l_orderkey, l_linenumber, 'RATE', null, 'missing' from w where l_linenumber = 1
union all select l_orderkey, l_linenumber, null, 'x;y', 'too many fields' from w where l_linenumber = 2""",
)

ORACLES["nearest_snapshot_stored"] = ORACLES["nearest_snapshot"]

oracle(
    "history_store_runs",
    _HISTORY.replace("select s.*, case", "select s.* replace (cast(round(h, 2) as decimal(24,3)) as h), case")
    .replace("when p between 7 and 9 then 3 when p = 11 then 2", "when p between 7 and 9 or p = 11 then 2"),
    *LEDGERS, BATCH.replace("case when p between 7 and 9 then 2 else 1 end run", "1 run"),
)
