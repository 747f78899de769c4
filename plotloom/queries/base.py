"""Registry, table access, and the shapes in which driver tables stand for trial data."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plotloom.literals import literal
from plotloom.operators.reshape import to_long

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(value, places: int = 6) -> Column:
    return F.round(value, places)


def numbered_sql(columns: Sequence[str], source: str, start: str = "0") -> str:
    """Ids after ``start`` in the order of ``assign_ids``."""
    text = ", ".join(f"coalesce(cast({c} as varchar), '')" for c in columns)
    order = ", ".join(f"{c} nulls first" for c in columns)
    return (
        f"select cast({start} + row_number() over (order by substr(md5(concat_ws('|', {text})), 1, 4), {order})"
        f" as bigint) as id, {', '.join(columns)} from {source}"
    )


# Trial sheets: one sheet row per line item, four trait columns ----------------------

TRAITS = {
    "yield_kg_m1": "l_quantity",
    "price_usd": "l_extendedprice",
    "share_pct_m2": "l_discount",
    "tax_pct": "l_tax",
}

FILE_SQL = (
    "concat(cast(year(l_shipdate) + 18 as varchar), '_', case l_linestatus when 'F' then 'GES' else 'Obregon' end,"
    " '_trial_', case l_returnflag when 'A' then 'Harvest' when 'N' then 'Lidar' else 'Q2' end, '.csv')"
)


def file_name() -> Column:
    """The sheet that a line item stands in."""
    site = F.when(F.col("l_linestatus") == "F", "GES").otherwise("Obregon")
    kind = F.when(F.col("l_returnflag") == "A", "Harvest").when(F.col("l_returnflag") == "N", "Lidar").otherwise("Q2")
    season = (F.year("l_shipdate") + 18).cast("string")
    return F.concat(season, F.lit("_"), site, F.lit("_trial_"), kind, F.lit(".csv"))


def trial_sheet(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    file = file_name()
    return lines.select(
        file.alias("file"),
        F.struct(file.alias("f"), (-F.col("l_orderkey")).alias("a"), (-F.col("l_linenumber")).alias("b")).alias("place"),
        F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")).alias("ID"),
        F.concat(F.lit("Panel "), F.col("l_linenumber").cast("string")).alias("Panel"),
        "l_shipdate",
        *[F.col(column).alias(trait) for trait, column in TRAITS.items()],
    )


TRIAL_SQL = f"""trial as (
  select {FILE_SQL} as file, concat('Supplier#', lpad(cast(l_suppkey as varchar), 9, '0')) as "ID",
    concat('Panel ', cast(l_linenumber as varchar)) as "Panel", l_orderkey, l_linenumber, l_shipdate,
    l_quantity as yield_kg_m1, l_extendedprice as price_usd, l_discount as share_pct_m2, l_tax as tax_pct
  from lineitem)"""


def trial_cells(sheet: DataFrame) -> DataFrame:
    return to_long(sheet, ["file", "ID", "l_shipdate"], list(TRAITS), "name", "value", drop_nulls=True)


def trial_headers(sheet: DataFrame) -> DataFrame:
    """(file, name) of every header, from the files' names alone."""
    names = F.array(*[F.lit(name) for name in TRAITS])
    return sheet.select("file").distinct().select("file", F.explode(names).alias("name"))


CELLS_SQL = """cells as (
  unpivot (select file, "ID", l_shipdate, yield_kg_m1, price_usd, share_pct_m2, tax_pct from trial)
  on yield_kg_m1, price_usd, share_pct_m2, tax_pct into name name value value)"""


def key_file(spark: SparkSession) -> DataFrame:
    return literal(spark, 
        [("yield", "Grain yield", "harvested mass"), ("price", "Price", "paid"), ("share", "Share", "of total")],
        "short_name string, name string, Description string",
    )


KEY_FILE_SQL = """key_file(short_name, name, description) as (values
  ('yield', 'Grain yield', 'harvested mass'), ('price', 'Price', 'paid'), ('share', 'Share', 'of total'))"""


def locations(spark: SparkSession) -> DataFrame:
    return literal(spark, [(1, "GES CR04"), (2, "GES VR11"), (3, "Obregon")], "id int, site_name_short string")


LOCATIONS_SQL = "locations(id, site_name_short) as (values (1, 'GES CR04'), (2, 'GES VR11'), (3, 'Obregon'))"


def entities(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as entities; those in debt are known by name only."""
    suppliers = table(spark, folder, "supplier")
    return suppliers.select(
        F.col("s_suppkey").cast("int").alias("id"),
        F.when(F.col("s_acctbal") >= 0, F.col("s_name")).alias("general_identifier"),
        F.when(F.col("s_acctbal") < -500, F.col("s_name")).alias("number"),
        F.col("s_name").alias("name"),
        F.lit(1).alias("entitytype_id"),
    )


ENTITIES_SQL = """entities as (
  select cast(s_suppkey as integer) as id, case when s_acctbal >= 0 then s_name end as general_identifier,
    case when s_acctbal < -500 then s_name end as number, s_name as name, 1 as entitytype_id from supplier)"""


def datasets(spark: SparkSession, folder: str) -> DataFrame:
    """One data set per season of the orders, site and data type; the last season is missing."""
    seasons = table(spark, folder, "orders").select((F.year("o_orderdate") + 18).alias("y")).distinct()
    kinds = ["Harvest", "Lidar", "Q2"]
    site = F.array(*[F.struct(F.lit(i).alias("n"), F.lit(s).alias("s")) for i, s in enumerate(["GES", "Obregon"])])
    kind = F.array(*[F.struct(F.lit(i).alias("n"), F.lit(k).alias("k")) for i, k in enumerate(kinds)])
    every = seasons.withColumn("s", F.explode(site)).withColumn("k", F.explode(kind))
    season = F.col("y").cast("string")
    name = F.when(F.col("s.s") == "GES", F.concat(F.lit("GES"), F.substring(season, 3, 2), F.lit("_trial"))).otherwise(
        F.when(F.col("y") == 2016, "CIMMYT2016").otherwise(F.concat(F.lit("Obregon"), season, F.lit("_trial")))
    )
    return every.select(
        (F.col("y") * 10 + F.col("s.n") * 3 + F.col("k.n")).cast("int").alias("id"),
        F.concat(name, F.lit(" "), F.col("k.k")).alias("description"),
        (F.col("y") - 2000).cast("int").alias("experiment_id"),
        F.concat(season, F.lit("_"), F.col("s.s"), F.lit("_trial_"), F.col("k.k"), F.lit(".csv")).alias("source_file"),
    )


DATASETS_SQL = """datasets as (
  select cast(y * 10 + s.n * 3 + k.n as integer) as id,
    concat(case when s.s = 'GES' then concat('GES', substr(cast(y as varchar), 3, 2), '_trial')
                when y = 2016 then 'CIMMYT2016' else concat('Obregon', cast(y as varchar), '_trial') end, ' ', k.k) as description,
    cast(y - 2000 as integer) as experiment_id,
    concat(cast(y as varchar), '_', s.s, '_trial_', k.k, '.csv') as source_file
  from (select distinct year(o_orderdate) + 18 as y from orders) o,
    (values (0, 'GES'), (1, 'Obregon')) s(n, s), (values (0, 'Harvest'), (1, 'Lidar'), (2, 'Q2')) k(n, k))"""


def phenotypes(spark: SparkSession) -> DataFrame:
    return literal(spark, 
        [(1, "Grain yield;m1", "yield;m1"), (2, "Price", "price"), (3, "Share;m3", "share;m3")],
        "id int, name string, short_name string",
    )


PHENOTYPES_SQL = """phenotypes(id, name, short_name) as (values
  (1, 'Grain yield;m1', 'yield;m1'), (2, 'Price', 'price'), (3, 'Share;m3', 'share;m3'))"""


# Daily growth series ------------------------------------------------------------------


def daily_growth(spark: SparkSession, folder: str) -> DataFrame:
    """(g, x, y): running total of event values per type and day, as a share of all days.

    Events are summed per type and day first, so the running total sees one row per day.
    """
    from pyspark.sql import Window

    events = table(spark, folder, "events")
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) + 1
    daily = events.groupBy(F.col("event_type").alias("g"), day.cast("double").alias("x")).agg(F.sum("value").alias("v"))
    so_far = Window.partitionBy("g").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("g")
    return daily.select("g", "x", (F.sum("v").over(so_far) / F.sum("v").over(whole) * 10).alias("y"))


GROWTH_SQL = """growth as (
  select g, x, sum(v) over (partition by g order by x) / sum(v) over (partition by g) * 10 as y
  from (select event_type as g, cast(date_diff('day', date '2024-01-01', cast(ts as date)) + 1 as double) as x,
          sum(value) as v from events group by 1, 2))"""
