"""Writes and what is read back, in the shared folder."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from plotloom.literals import literal
from plotloom.plans import trials as T
from plotloom.queries.base import (
    datasets,
    entities,
    key_file,
    locations,
    query,
    table,
    trial_cells,
    trial_headers,
    trial_sheet,
)
from plotloom.queries.keys import RESOLVED_SQL
from plotloom.session import cut_lineage, ensure_checkpoint_dir
from plotloom.sources import sheets, versions
from plotloom.sources import tables as TB
from plotloom.sources.unit import UnitOfWork, read_committed, run_unit


def scratch(spark) -> str:
    """A new folder that all executors see."""
    return f"{ensure_checkpoint_dir(spark)}/sinks-{uuid4().hex}"


UNITS = "id long, unit_abbreviation string, unit_name string, unit_description string"
PHENOTYPES = "id long, name string, short_name string, description string, datatype string, unit_id string"
VALUES = "phenotype_id long, germinatebase_id int, phenotype_value string, dataset_id int, location_id int"


def trait_unit(spark, folder) -> tuple[str, UnitOfWork]:
    """Units, traits and values of the trial sheets as one unit of work."""
    location = scratch(spark)
    first = UnitOfWork(spark, location, "empty tables")
    for name, schema in (("units", UNITS), ("phenotypes", PHENOTYPES), ("phenotypedata", VALUES)):
        first.put(name, literal(spark, [], schema))
    first.commit()
    sheet = trial_sheet(spark, folder)
    headers = trial_headers(sheet)
    cells, key = trial_cells(sheet), key_file(spark)
    unit_file = literal(spark, [("kg", "kilogram", "mass")], "unit_abbreviation string, unit_name string, unit_description string")
    fixed = {"germinatebase": entities(spark, folder), "datasets": datasets(spark, folder), "locations": locations(spark)}
    steps = {
        "units": lambda unit: T.load_units(headers, key, unit_file, unit.tables(["units"])),
        "phenotypes": lambda unit: T.load_phenotypes(headers, key, unit.tables(["units", "phenotypes"])),
        "phenotypedata": lambda unit: T.load_phenotype_data(
            cells, key, {**fixed, **unit.tables(["phenotypes", "phenotypedata"])}, headers=headers
        ),
    }
    return location, run_unit(spark, location, "trial sheets", steps)


# The unit loads share;m2 itself, where other queries have an unknown measure.
UNIT_SQL = RESOLVED_SQL.replace("'share;m3'", "'share;m2'")
COMPLETE = "phenotype_id is not null and germinatebase_id is not null and dataset_id is not null"


@query(
    "unit_of_work",
    f"""{UNIT_SQL}
select 'units' as target, 3::bigint as rows_added, 0::bigint as rejected union all select 'phenotypes', 3, 0
union all select 'phenotypedata', count(*) filter ({COMPLETE}), count(*) filter (not ({COMPLETE})) from resolved""",
)
def unit_of_work(spark, folder):
    """Rows added and rejected, per table of one unit."""
    return trait_unit(spark, folder)[1].report()


@query(
    "unit_contents",
    f"""{UNIT_SQL}
select case phenotype_id when 1 then 'yield;m1' when 2 then 'price' else 'share;m2' end as trait, dataset_id, location_id,
  count(*) as n, round(sum(phenotype_value), 2) as total from resolved where {COMPLETE} group by all""",
)
def unit_contents(spark, folder):
    """What readers see once the unit is committed."""
    location, _ = trait_unit(spark, folder)
    values = read_committed(spark, location, "phenotypedata")
    names = read_committed(spark, location, "phenotypes").selectExpr("id as phenotype_id", "short_name as trait")
    joined = values.join(names, "phenotype_id")
    total = F.round(F.sum(F.col("phenotype_value").cast("double")), 2)
    return joined.groupBy("trait", "dataset_id", "location_id").agg(F.count("*").alias("n"), total.alias("total"))


@query("append_and_verify", 'select count(*) as rows, 3 as "columns" from orders')
def append_and_verify(spark, folder):
    """Orders appended in two writes, then read back."""
    path = scratch(spark)
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    TB.append(orders.where("o_orderkey % 3 = 0"), path)
    TB.append(orders.where("o_orderkey % 3 <> 0"), path)
    return TB.verify_load(spark, path)


@query(
    "replace_table",
    """select s_suppkey, s_name, case when s_nationkey < 10 then n_name else cast(s_nationkey as varchar) end as place
from supplier left join nation on n_nationkey = s_nationkey""",
)
def replace_table(spark, folder):
    """A column recomputed for some keys, written to a new path and read back."""
    suppliers = table(spark, folder, "supplier")
    stored = suppliers.select("s_suppkey", "s_name", F.col("s_nationkey").cast("string").alias("place"))
    nations = table(spark, folder, "nation").where("n_nationkey < 10").select("n_nationkey", "n_name")
    updates = suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_name").alias("place"))
    path = scratch(spark)
    TB.replace(TB.update_column(stored, updates, "s_suppkey", "place"), path)
    return spark.read.parquet(path)


@query(
    "update_files",
    """with s as (select *, o_orderkey % 997 = 5 as hit from orders)
select o_orderkey, case when hit then null else o_custkey end as o_custkey from s""",
)
def update_files(spark, folder):
    """One column of few rows set to null in the files that hold them, twice under one name."""
    path = scratch(spark)
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    versions.create(orders.repartitionByRange(16, "o_orderkey"), path)
    hit = orders.where(F.col("o_orderkey") % 997 == 5)
    updates = hit.select("o_orderkey", F.lit(None).cast("long").alias("o_custkey"))
    versions.update(spark, path, "no customer", updates, "o_orderkey", "o_custkey")
    versions.update(spark, path, "no customer", updates, "o_orderkey", "o_custkey")
    return versions.read(spark, path)


@query(
    "csv_round_trip",
    """select cast(s_suppkey as varchar) as s_suppkey, s_name, case when s_acctbal >= 0 then concat('in "credit", ', s_name) end as note
from supplier""",
)
def csv_round_trip(spark, folder):
    """Written as CSV files with quotes, commas and empty cells, and read as one sheet."""
    path = scratch(spark)
    note = F.when(F.col("s_acctbal") >= 0, F.concat(F.lit('in "credit", '), "s_name"))
    frame = table(spark, folder, "supplier").select("s_suppkey", "s_name", note.alias("note"))
    TB.write_csv(frame, path)
    return sheets.read_sheet(spark, path)


@query("stage_round_trip", "select o_custkey, count(*) as n from orders group by o_custkey")
def stage_round_trip(spark, folder):
    """A stage kept in the shared folder."""
    return cut_lineage(table(spark, folder, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")))


@query("read_two_tables", "select n_name, r_name from nation join region on n_regionkey = r_regionkey")
def read_two_tables(spark, folder):
    found = TB.read_tables(spark, folder, ["nation.parquet", "region.parquet"])
    nation, region = found["nation.parquet"], found["region.parquet"]
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select("n_name", "r_name")


@query("named_tables", "select * from (values ('listed_nation'), ('listed_region')) t(name)")
def named_tables(spark, folder):
    for name in ("nation", "region"):
        table(spark, folder, name).createOrReplaceTempView(f"listed_{name}")
    names = [(name,) for name in TB.list_tables(spark) if name.startswith("listed_")]
    return literal(spark, names, "name string")


TYPES = ("Harvest", "Lidar")


@query(
    "keep_types",
    """select l_orderkey, l_linenumber, case l_returnflag when 'A' then 'Harvest' else 'Lidar' end as datatype
from lineitem where l_returnflag in ('A', 'N')""",
)
def keep_types(spark, folder):
    """Sheet rows whose file is of a listed type."""
    from plotloom.functions.domain import file_name_parts

    place = F.col("place")
    rows = file_name_parts(trial_sheet(spark, folder)).where(F.col("datatype").isin(*TYPES))
    return rows.select((-place["a"]).alias("l_orderkey"), (-place["b"]).alias("l_linenumber"), "datatype")


@query(
    "keep_either",
    "select s_suppkey from supplier where s_nationkey in (1, 2, 3) or s_suppkey % 10 in (5, 6)",
)
def keep_either(spark, folder):
    """Rows in one list or the other."""
    listed = F.col("s_nationkey").isin(1, 2, 3) | (F.col("s_suppkey") % 10).isin(5, 6)
    return table(spark, folder, "supplier").where(listed).select("s_suppkey")
