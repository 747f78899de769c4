"""Wide to long, long to wide, unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from plotloom.operators import reshape as R
from plotloom.queries.base import CELLS_SQL, TRIAL_SQL, query, table, trial_cells, trial_sheet


@query("to_long", f"with {TRIAL_SQL}, {CELLS_SQL} select file, \"ID\", name, cast(value as double) as value from cells")
def to_long(spark, folder):
    cells = trial_cells(trial_sheet(spark, folder))
    return cells.select("file", "ID", "name", F.col("value").cast("double").alias("value"))


@query(
    "to_long_without_ids",
    """
select name, value, cast(count(*) as bigint) as n from (
  unpivot (select cast(p_size as varchar) as size, p_brand as brand, nullif(p_type, 'PROMO') as kind from part)
  on size, brand, kind into name name value value)
group by 1, 2""",
)
def to_long_without_ids(spark, folder):
    """No id column; empty cells are dropped, the rest is counted."""
    parts = table(spark, folder, "part").select(
        F.col("p_size").alias("size"), F.col("p_brand").alias("brand"), F.nullif("p_type", F.lit("PROMO")).alias("kind")
    )
    long = R.to_long(parts, [], drop_nulls=True)
    return long.groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))


@query(
    "attributes_to_long",
    """
with wide as (select p_partkey, nullif(p_brand, 'Brand#7') as "Cross", nullif(p_type, 'PROMO') as "Pedigree",
  case when p_size > 30 then cast(p_size as varchar) end as "Source" from part)
select p_partkey, 1 as attribute_id, "Cross" as value from wide where "Cross" is not null
union all select p_partkey, 2, "Pedigree" from wide where "Pedigree" is not null
union all select p_partkey, 3, "Source" from wide where "Source" is not null""",
)
def attributes_to_long(spark, folder):
    from plotloom.functions.domain import ATTRIBUTE_IDS

    wide = table(spark, folder, "part").select(
        "p_partkey",
        F.nullif("p_brand", F.lit("Brand#7")).alias("Cross"),
        F.nullif("p_type", F.lit("PROMO")).alias("Pedigree"),
        F.when(F.col("p_size") > 30, F.col("p_size")).alias("Source"),
    )
    return R.attributes_to_long(wide, ["p_partkey"], {n: ATTRIBUTE_IDS[n] for n in ("Cross", "Pedigree", "Source")})


YEARS = [1995, 1996, 1997, 1998, 1999, 2000]


@query(
    "to_wide",
    "select o_orderpriority, "
    + ", ".join(f'round(avg(case when year(o_orderdate) = {y} then o_totalprice end), 4) as "{y}"' for y in YEARS)
    + " from orders group by 1",
)
def to_wide(spark, folder):
    orders = table(spark, folder, "orders").withColumn("y", F.year("o_orderdate"))
    return R.to_wide(orders, ["o_orderpriority"], "y", YEARS, F.round(F.avg("o_totalprice"), 4))


@query(
    "grid_slice",
    """
select l_linenumber, """
    + ", ".join(f"max(case when l_returnflag = '{f}' then n end) as {f}" for f in "ANR")
    + """ from (select l_linenumber, l_returnflag, l_linestatus, cast(count(*) as bigint) as n from lineitem group by 1, 2, 3)
where l_linestatus = 'F' group by 1""",
)
def grid_slice(spark, folder):
    counts = table(spark, folder, "lineitem").groupBy("l_linenumber", "l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n")
    )
    return R.grid_slice(counts, {"l_linestatus": "F"}, "l_linenumber", "l_returnflag", ["A", "N", "R"], "n")


@query(
    "union_all",
    """
select c_custkey as key, c_name as name, c_acctbal as balance from customer
union all select s_suppkey, s_name, s_acctbal from supplier""",
)
def union_all(spark, folder):
    customers = table(spark, folder, "customer").selectExpr("c_custkey as key", "c_name as name", "c_acctbal as balance")
    suppliers = table(spark, folder, "supplier").selectExpr("s_acctbal as balance", "s_suppkey as key", "s_name as name")
    return R.union_all([customers, suppliers])


@query(
    "union_missing_columns",
    """
select c_custkey as key, c_name as name, c_mktsegment as segment from customer
union all select s_suppkey, s_name, null from supplier""",
)
def union_missing_columns(spark, folder):
    customers = table(spark, folder, "customer").selectExpr("c_custkey as key", "c_name as name", "c_mktsegment as segment")
    suppliers = table(spark, folder, "supplier").selectExpr("s_suppkey as key", "s_name as name")
    return R.union_all([customers, suppliers], allow_missing=True)


@query(
    "drop_incomplete",
    """
select * from (select l_orderkey, l_linenumber, nullif(l_returnflag, 'N') as flag, nullif(l_discount, 0.0) as discount from lineitem)
where flag is not null and discount is not null""",
)
def drop_incomplete(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.nullif("l_returnflag", F.lit("N")).alias("flag"), F.nullif("l_discount", F.lit(0.0)).alias("discount"),
    )
    return R.drop_incomplete(lines)


@query(
    "with_constants",
    "select distinct concat('Panel ', cast(l_linenumber as varchar)) as name, 'Accession panel' as description,"
    " 1 as visibility, 3 as grouptype_id from lineitem",
)
def with_constants(spark, folder):
    names = trial_sheet(spark, folder).select(F.col("Panel").alias("name")).distinct()
    return R.with_constants(names, {"description": "Accession panel", "visibility": 1, "grouptype_id": 3})


@query(
    "prefix_columns",
    """
unpivot (select l_orderkey, l_linenumber, l_discount, l_tax from lineitem)
on l_discount, l_tax into name name value value""",
)
def prefix_columns(spark, folder):
    """The measured columns are picked by their prefix and turned into rows."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    chosen = R.columns_with_prefix(lines, "l_d") + R.columns_with_prefix(lines, "l_t")
    long = R.to_long(lines, ["l_orderkey", "l_linenumber"], chosen)
    return long.withColumn("value", F.col("value").cast("double"))
