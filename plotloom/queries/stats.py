"""Aggregates, windows, samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from plotloom.operators import stats as A
from plotloom.queries.base import GROWTH_SQL, daily_growth, query, rounded, table


@query(
    "mean_strict",
    """
select l_suppkey, l_linenumber, case when count(d) = count(*) then round(avg(d), 6) end as mean
from (select l_suppkey, l_linenumber, nullif(l_discount, 0.0) as d from lineitem) group by 1, 2""",
)
def mean_strict(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn("d", F.nullif("l_discount", F.lit(0.0)))
    return lines.groupBy("l_suppkey", "l_linenumber").agg(rounded(A.mean_strict("d")).alias("mean"))


@query("mean_by_time", "select l_shipdate, round(avg(l_quantity), 6) as mean from lineitem group by 1")
def mean_by_time(spark, folder):
    return A.mean_by(table(spark, folder, "lineitem"), ["l_shipdate"], "l_quantity").withColumn("mean", rounded("mean"))


@query("distinct_rows", "select distinct l_suppkey, l_returnflag, l_linestatus from lineitem")
def distinct_rows(spark, folder):
    return table(spark, folder, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus").dropDuplicates()


@query("frequency", "select lang, source, cast(count(*) as bigint) as n from documents group by 1, 2")
def frequency(spark, folder):
    return A.freq(table(spark, folder, "documents"), "lang", "source")


@query("range_of", "select event_type, min(value) as low, max(value) as high from events group by 1")
def range_of(spark, folder):
    return A.range_of(table(spark, folder, "events"), ["event_type"], "value")


@query("count_groups", "select cast(count(distinct user_id) as bigint) as users, cast(count(*) as bigint) as n from events")
def count_groups(spark, folder):
    return table(spark, folder, "events").agg(F.countDistinct("user_id").alias("users"), F.count(F.lit(1)).alias("n"))


@query(
    "vocabulary",
    """
select source, first_pos, cast(row_number() over (order by first_pos, source) - 1 as bigint) as index
from (select source, min(doc_id) as first_pos from documents where source is not null group by 1)""",
)
def vocabulary(spark, folder):
    return A.vocabulary(table(spark, folder, "documents"), "source", "doc_id")


@query(
    "vocabulary_long",
    """
select user_id, first_pos, cast(row_number() over (order by first_pos, user_id) - 1 as bigint) as index
from (select user_id, min(event_id) as first_pos from events group by 1)""",
)
def vocabulary_long(spark, folder):
    """A word list as long as the data has users."""
    return A.vocabulary(table(spark, folder, "events"), "user_id", "event_id")


RESIDUAL_SQL = """line as (select l_returnflag as flag, regr_slope(l_extendedprice, l_quantity) as a,
    regr_intercept(l_extendedprice, l_quantity) as m0 from lineitem group by 1),
resid as (select l_returnflag as flag, (m0 + a * l_quantity) / 1000 as fitted,
    (l_extendedprice - (m0 + a * l_quantity)) / 1000 as resid from lineitem join line on flag = l_returnflag)"""


@query(
    "fit_stats",
    f"""
with {RESIDUAL_SQL}, s as (select flag, cast(count(*) as double) as n, var_pop(fitted) * count(*) as mss, sum(resid * resid) as rss
  from resid group by 1), l as (select *, -n * (ln(2 * pi()) + 1 - ln(n) + ln(rss)) / 2 as ll from s)
select flag, n, round(mss, 2) as mss, round(rss, 2) as rss, round(mss / (mss + rss), 6) as r2, round(sqrt(rss), 5) as root_rss,
  round(sqrt(rss / n), 6) as rmse, round(ll, 4) as ll, round(-2 * ll + 2 * 3, 4) as aic from l""",
)
def fit_stats(spark, folder):
    """Price on quantity by flag: two passes over the lines, each a partial aggregate."""
    from plotloom.growth.fit import fit_linear
    from plotloom.growth.models import add_residuals
    from plotloom.operators.sizing import attach

    lines = table(spark, folder, "lineitem").selectExpr("l_returnflag as flag", "l_quantity as x", "l_extendedprice as y")
    fitted = add_residuals(attach(lines, fit_linear(lines, ["flag"]).drop("n"), ["flag"]), "linear")
    scaled = fitted.withColumns({"fitted": F.col("fitted") / 1000, "resid": F.col("resid") / 1000})
    places = {"mss": 2, "rss": 2, "r2": 6, "root_rss": 5, "rmse": 6, "ll": 4, "aic": 4}
    stats = A.fit_stats(scaled, ["flag"], 2)
    return stats.select("flag", "n", *[rounded(name, digits).alias(name) for name, digits in places.items()])


@query(
    "best_by",
    """
select l_suppkey, b.o as l_orderkey, b.l as l_linenumber, b.p as l_extendedprice from (
  select l_suppkey, arg_min({'o': l_orderkey, 'l': l_linenumber, 'p': l_extendedprice},
    {'s': -l_extendedprice, 'a': l_orderkey, 'b': l_linenumber}) as b from lineitem group by 1)""",
)
def best_by(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    return A.best_by(lines, ["l_suppkey"], "l_extendedprice", ["l_orderkey", "l_linenumber"])


@query(
    "peak",
    """
select event_type, max(value) as peak, arg_min(event_id, {'s': -value, 't': event_id}) as peak_time from events group by 1""",
)
def peak(spark, folder):
    return A.peak(table(spark, folder, "events"), ["event_type"], "event_id", "value")


@query(
    "relative_difference",
    """
select l_suppkey, round((a - r) / a, 6) as diff from (
  select l_suppkey, avg(case when l_returnflag = 'A' then l_extendedprice end) as a,
    avg(case when l_returnflag = 'R' then l_extendedprice end) as r from lineitem group by 1)""",
)
def relative_difference(spark, folder):
    flag = lambda f: F.avg(F.when(F.col("l_returnflag") == f, F.col("l_extendedprice")))
    means = table(spark, folder, "lineitem").groupBy("l_suppkey").agg(flag("A").alias("a"), flag("R").alias("r"))
    return means.select("l_suppkey", rounded(A.rel_diff("a", "r")).alias("diff"))


@query(
    "histogram",
    """
with r as (select min(o_totalprice) as lo, max(o_totalprice) as hi from orders)
select cast(least(floor((o_totalprice - lo) / (hi - lo) * 10), 9) as integer) as bin, cast(count(*) as bigint) as n
from orders, r group by 1""",
)
def histogram(spark, folder):
    return A.histogram(table(spark, folder, "orders"), [], "o_totalprice", 10)


@query(
    "histogram_by_group",
    """
with r as (select event_type, min(value) as lo, max(value) as hi from events group by 1)
select event_type, cast(least(floor((value - lo) / (hi - lo) * 30), 29) as integer) as bin, cast(count(*) as bigint) as n
from events join r using (event_type) group by 1, 2""",
)
def histogram_by_group(spark, folder):
    return A.histogram(table(spark, folder, "events"), ["event_type"], "value", 30)


@query(
    "slope_init",
    f"""
with {GROWTH_SQL}
select g, round(regr_slope(ln(y), x), 6) as slope, round(min(y), 6) as low, cast(count(*) as bigint) as points
from (select g, x, avg(y) as y from growth group by 1, 2) group by 1""",
)
def slope_init(spark, folder):
    start = A.slope_init(daily_growth(spark, folder), ["g"], "x", "y", log=True)
    return start.withColumns({"slope": rounded("slope"), "low": rounded("low")})


MONTHLY_SQL = """(select o_orderpriority as p, cast(year(o_orderdate) * 12 + month(o_orderdate) as integer) as m, o_totalprice as v from orders)"""


def _monthly(spark, folder):
    month = (F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("m")
    return table(spark, folder, "orders").select(F.col("o_orderpriority").alias("p"), month, F.col("o_totalprice").alias("v"))


@query(
    "stepwise_rgr",
    f"""
select p, m, round(mean_y, 4) as mean_y,
  round((ln(mean_y) - lag(ln(mean_y)) over w) / (m - lag(m) over w), 6) as rgr
from (select p, m, avg(v) as mean_y from {MONTHLY_SQL} group by 1, 2) window w as (partition by p order by m)""",
)
def stepwise_rgr(spark, folder):
    steps = A.stepwise_rgr(_monthly(spark, folder), ["p"], "m", "v")
    return steps.withColumns({"mean_y": rounded("mean_y", 4), "rgr": rounded("rgr")})


@query(
    "classic_rgr",
    f"""
select p, x_first, x_last, round(y_first, 4) as y_first, round(y_last, 4) as y_last,
  round(ln(y_last / y_first) / (x_last - x_first), 8) as rgr
from (select p, min(m) as x_first, max(m) as x_last, arg_min(y, m) as y_first, arg_max(y, m) as y_last
  from (select p, m, avg(v) as y from {MONTHLY_SQL} group by 1, 2) group by 1)""",
)
def classic_rgr(spark, folder):
    ends = A.classic_rgr(_monthly(spark, folder), ["p"], "m", "v")
    return ends.withColumns({"y_first": rounded("y_first", 4), "y_last": rounded("y_last", 4), "rgr": rounded("rgr", 8)})


@query(
    "sample_groups",
    """
select event_id, user_id, event_type from events where user_id in (
  select user_id from (select distinct user_id from events) order by md5(concat_ws('|', cast(user_id as varchar), '1')), user_id limit 9)""",
)
def sample_groups(spark, folder):
    """All events of nine users drawn by hash."""
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    return A.sample_groups(events, ["user_id"], 9, "1")


@query(
    "peek",
    "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 6",
)
def peek(spark, folder):
    """The first rows in a stated order."""
    from plotloom.sources.tables import peek as first_rows

    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return first_rows(orders, 6, [F.col("o_totalprice").desc(), "o_orderkey"])


@query(
    "load_report",
    """
select 'orders' as target, cast(count(*) as bigint) as rows_added from orders
union all select 'customer', cast(count(*) as bigint) from customer""",
)
def load_report(spark, folder):
    from plotloom.sources.tables import load_report as report

    return report({"orders": table(spark, folder, "orders"), "customer": table(spark, folder, "customer")})


@query(
    "dimensions",
    "select cast(count(*) as bigint) as rows, 11 as columns from lineitem",
)
def dimensions(spark, folder):
    from plotloom.sources.tables import dimensions as shape

    return shape(table(spark, folder, "lineitem"))


@query(
    "update_column",
    """
select c.c_custkey, c.c_mktsegment, case when o.o_custkey is not null then o.last else c.c_acctbal end as c_acctbal
from customer c left join (
  select o_custkey, max(o_totalprice) as last from orders where o_orderstatus = 'F' group by 1) o on o.o_custkey = c.c_custkey""",
)
def update_column(spark, folder):
    """Customers with orders take a new balance, the others keep theirs."""
    from plotloom.sources.tables import update_column as update

    newest = table(spark, folder, "orders").where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_totalprice").alias("c_acctbal")
    )
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return update(customers, newest, "c_custkey", "c_acctbal")
