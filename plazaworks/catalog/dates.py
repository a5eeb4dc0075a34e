"""Dates and times."""

from pyspark.sql import functions as F

from ..functions import dates as D
from ..plans.orders import first_sale
from .registry import day, query, stamp


@query("""
SELECT o_orderkey, strftime(o_orderdate,'%Y-%m') AS period, CAST(year(o_orderdate) AS BIGINT) AS y, CAST(month(o_orderdate) AS BIGINT) AS m, CAST(dayofweek(o_orderdate)+1 AS BIGINT) AS dow,
 CAST(strftime(o_orderdate,'%U') AS BIGINT) AS week, strftime(date_trunc('week',o_orderdate),'%Y%m%d')||'-'||strftime(date_trunc('week',o_orderdate)+INTERVAL 6 DAY,'%Y%m%d') AS label FROM orders
""")
def period_labels(t):
    """Periods, Sunday-based weeks, settlement weeks."""
    o, d = t("orders", "o_orderkey", "o_orderdate"), F.col("o_orderdate")
    return o.select(
        "o_orderkey", D.period_label(d).alias("period"), F.year(d).cast("bigint").alias("y"), F.month(d).cast("bigint").alias("m"), F.dayofweek(d).cast("bigint").alias("dow"),
        D.week_from_sunday(d).cast("bigint").alias("week"), D.settlement_week(d).alias("label"),
    )


_PAIRS = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate + to_hours(CAST(l_partkey%24 AS INT)) + to_minutes(CAST(l_suppkey%60 AS INT)) AS x,
 o_orderdate + to_hours(CAST(l_suppkey%24 AS INT)) + to_minutes(CAST(l_partkey%60 AS INT)) AS y, l_extendedprice FROM lineitem JOIN orders ON l_orderkey=o_orderkey"""


def _pairs(t):
    l = t("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    rows = l.join(t("orders", "o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    at = lambda d, h, m: F.col(d) + F.make_dt_interval(hours=(F.col(h) % 24).cast("int"), mins=(F.col(m) % 60).cast("int"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", at("l_shipdate", "l_partkey", "l_suppkey").alias("x"), at("o_orderdate", "l_suppkey", "l_partkey").alias("y"))


@query(f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CAST(date_diff('day',y,x) AS BIGINT) AS days, CAST(date_diff('month',y,x) AS BIGINT) AS months, CAST(date_diff('hour',y,x) AS BIGINT) AS hours_crossed,
 CAST(trunc(epoch(x-y)/3600) AS BIGINT) AS hours_whole FROM ({_PAIRS})
""")
def date_differences(t):
    """Day and month boundaries, hour boundaries and whole hours."""
    return _pairs(t).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", D.days_between("x", "y").cast("bigint").alias("days"), D.months_crossed("x", "y").cast("bigint").alias("months"),
        D.hours_crossed("x", "y").alias("hours_crossed"), D.whole_hours("x", "y").alias("hours_whole"),
    )


@query(f"""
WITH n AS (SELECT *, least(greatest(x-INTERVAL 9 HOUR, date_trunc('day',x)), date_trunc('day',x)+INTERVAL 9 HOUR) AS a, least(greatest(y-INTERVAL 9 HOUR, date_trunc('day',y)), date_trunc('day',y)+INTERVAL 9 HOUR) AS b FROM ({_PAIRS})),
w AS (SELECT *, (CAST(a AS DATE)-CAST(dayofweek(a) AS INT)) AS sa, (CAST(b AS DATE)-CAST(dayofweek(b) AS INT)) AS sb FROM n),
c AS (SELECT *, date_diff('day',sb,sa)//7*5 + len(list_filter([1,2,3,4,5], lambda k: k<=dayofweek(a)+1)) - len(list_filter([1,2,3,4,5], lambda k: k<=dayofweek(b)+1)) AS wd FROM w)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CAST(wd AS BIGINT) AS working_days,
 CAST(wd*9*3600 + (hour(a)*3600+minute(a)*60+second(a)) - (hour(b)*3600+minute(b)*60+second(b)) AS BIGINT) AS working_seconds, CAST(trunc(epoch(x-y)/3600) AS BIGINT) AS hours FROM c
""")
def work_time(t):
    """Working seconds and days between two times, and plain hours."""
    w = D.work_time("x", "y")
    return _pairs(t).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", w["working_days"].alias("working_days"), w["working_seconds"].alias("working_seconds"), w["hours"].alias("hours"))


@query("""
SELECT event_id, strftime(ts-INTERVAL 5 HOUR,'%Y-%m-%d %H:%M:%S') AS local, strftime(ts-INTERVAL 5 HOUR,'%Y-%m-%d %H:%M:%S') AS shifted,
 CASE WHEN CAST(ts AS DATE)=DATE '2024-01-12' THEN 1 ELSE 0 END AS cohort, CAST(hour(ts) AS BIGINT) AS h FROM events
""")
def local_times(t):
    """Civil time of the reports' zone; cohort of three days ago."""
    e = t("events", "event_id", "ts")
    return e.select(
        "event_id", stamp(D.to_local("ts")).alias("local"), stamp(D.minus_five_hours("ts")).alias("shifted"),
        F.when(D.days_ago("ts", "2024-01-15", 3), 1).otherwise(0).alias("cohort"), F.hour("ts").cast("bigint").alias("h"),
    )


@query("""
SELECT o_orderkey, strftime(o_orderdate,'%Y-%m-%d') AS parsed, CASE WHEN o_orderkey%3=0 THEN NULL ELSE strftime(o_orderdate,'%Y-%m-%d') END AS repaired, CAST(NULL AS VARCHAR) AS bad FROM orders
""")
def parsed_dates(t):
    """Dates written day first, hand-typed month first with swallowed slashes, and nonsense."""
    o = t("orders", "o_orderkey", "o_orderdate")
    d = F.col("o_orderdate")
    typed = F.when(F.col("o_orderkey") % 3 == 0, F.lit("0/01/1900")).otherwise(F.date_format(d, "MM/d/yyyy"))
    return o.select(
        "o_orderkey", day(D.parse_date(F.date_format(d, "d/M/yyyy"))).alias("parsed"), day(D.repair_mdy(typed)).alias("repaired"),
        day(D.parse_date(F.concat(F.lit("31/02/"), F.year(d).cast("string")))).alias("bad"),
    )


_FIRST = """SELECT o_custkey, o_orderkey FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY sold_at, o_orderkey) rn
 FROM (SELECT *, o_orderdate + to_hours(CAST(o_orderkey%24 AS INT)) AS sold_at FROM orders) WHERE o_orderstatus<>'P') WHERE rn=1"""


@query(f"{_FIRST} AND sold_at>=TIMESTAMP '1995-01-13 18:00:00' AND sold_at<TIMESTAMP '1995-03-06 08:00:00'")
def first_sale_window(t):
    """First sale of each customer, if it falls between the Friday cut-off and Monday morning weeks later."""
    o = t("orders", "o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    o = o.withColumn("sold_at", F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int")))
    window = (D.reporting_window("1995-01-16")[0], D.reporting_window("1995-03-06")[1])
    return first_sale(o, window, "o_custkey", "sold_at", "o_orderstatus", "o_orderkey", ["P"]).select("o_custkey", "o_orderkey")


@query("""
SELECT event_id FROM events WHERE ts>=TIMESTAMP '2024-01-12 18:00:00' AND ts<TIMESTAMP '2024-01-15 08:00:00'
UNION ALL SELECT event_id FROM events WHERE ts>=TIMESTAMP '2024-01-16 08:00:00' AND ts<TIMESTAMP '2024-01-16 18:00:00'
""")
def reporting_slots(t):
    """Events of a Monday morning slot and of a Tuesday afternoon slot."""
    e = t("events", "event_id", "ts")
    am, pm = D.reporting_window("2024-01-15", "am"), D.reporting_window("2024-01-16", "pm")
    return e.where(D.within("ts", am) | D.within("ts", pm)).select("event_id")
