"""Lookups, append-if-absent, membership, parents, numbering."""

from __future__ import annotations

from pyspark.sql import functions as F

from plotloom.functions.scalar import glue
from plotloom.literals import literal
from plotloom.operators import keys as K
from plotloom.operators.numbering import assign_ids, number_rows
from plotloom.plans.trials import load_phenotype_data
from plotloom.queries.base import (
    CELLS_SQL,
    DATASETS_SQL,
    ENTITIES_SQL,
    KEY_FILE_SQL,
    LOCATIONS_SQL,
    PHENOTYPES_SQL,
    TRIAL_SQL,
    datasets,
    entities,
    key_file,
    locations,
    numbered_sql,
    phenotypes,
    query,
    table,
    trial_cells,
    trial_headers,
    trial_sheet,
)

LOADED_BEFORE = "1998-01-01"

RESOLVED_SQL = f"""
with {TRIAL_SQL}, {CELLS_SQL}, {KEY_FILE_SQL}, {LOCATIONS_SQL}, {ENTITIES_SQL}, {DATASETS_SQL}, {PHENOTYPES_SQL},
parts as (
  select *, split_part(name, '_', 1) as short_name, nullif(split_part(name, '_', 3), '') as measure_id,
    split_part(file, '_', 1) as year, split_part(file, '_', 2) as site, split_part(file, '_', 3) as trial_name,
    replace(split_part(file, '_', 4), '.csv', '') as datatype
  from cells where split_part(name, '_', 1) in (select short_name from key_file)),
described as (
  select *, concat(case when concat(site, year, '_', trial_name) = 'Obregon2016_trial' then 'CIMMYT2016'
      when site = 'GES' then concat('GES', substr(year, 3), '_', trial_name)
      else concat(site, year, '_', trial_name) end, ' ', datatype) as description,
    case when site = 'GES' then case when year = '2017' then 'GES CR04' else 'GES VR11' end else site end as site_name_short
  from parts),
resolved as (
  select coalesce(p1.id, p2.id) as phenotype_id, coalesce(e1.id, e2.id) as germinatebase_id,
    d.value as phenotype_value, s.id as dataset_id, l.id as location_id, d.l_shipdate
  from described d
  left join phenotypes p1 on p1.short_name = d.short_name
  left join phenotypes p2 on p2.short_name = concat_ws(';', d.short_name, d.measure_id) and d.measure_id is not null
  left join (select general_identifier, min(id) as id from entities group by 1) e1 on e1.general_identifier = d."ID"
  left join (select name, min(id) as id from entities group by 1) e2 on e2.name = d."ID"
  left join datasets s on s.description = d.description
  left join locations l on l.site_name_short = d.site_name_short)"""


@query(
    "trait_load",
    RESOLVED_SQL
    + f""", stored as (
  select distinct phenotype_id, germinatebase_id, dataset_id from resolved where l_shipdate < date '{LOADED_BEFORE}')
select phenotype_id, germinatebase_id, cast(phenotype_value as double) as phenotype_value, dataset_id, location_id
from resolved r
where phenotype_id is not null and germinatebase_id is not null and dataset_id is not null
  and not exists (select 1 from stored s where s.phenotype_id = r.phenotype_id
    and s.germinatebase_id = r.germinatebase_id and s.dataset_id = r.dataset_id)""",
)
def trait_load(spark, folder):
    """Wide sheet to long values, header split, four lookups, append-if-absent on three keys."""
    tables = {
        "germinatebase": entities(spark, folder),
        "datasets": datasets(spark, folder),
        "locations": locations(spark),
        "phenotypes": phenotypes(spark),
    }
    empty = "phenotype_id int, germinatebase_id int, dataset_id int"
    tables["phenotypedata"] = literal(spark, [], empty)
    sheet = trial_sheet(spark, folder)
    cells, headers = trial_cells(sheet), trial_headers(sheet)
    earlier = cells.where(F.col("l_shipdate") < F.lit(LOADED_BEFORE).cast("timestamp_ntz"))
    stored = load_phenotype_data(earlier, key_file(spark), tables, headers=headers).new_rows
    tables["phenotypedata"] = stored.select("phenotype_id", "germinatebase_id", "dataset_id")
    new = load_phenotype_data(cells, key_file(spark), tables, headers=headers).new_rows
    return new.withColumn("phenotype_value", F.col("phenotype_value").cast("double"))


@query(
    "trait_load_rejects",
    RESOLVED_SQL
    + """
select phenotype_id, germinatebase_id, cast(phenotype_value as double) as phenotype_value, dataset_id, location_id
from resolved where phenotype_id is null or germinatebase_id is null or dataset_id is null""",
)
def trait_load_rejects(spark, folder):
    """Rows of the same load whose key is incomplete."""
    tables = {
        "germinatebase": entities(spark, folder),
        "datasets": datasets(spark, folder),
        "locations": locations(spark),
        "phenotypes": phenotypes(spark),
        "phenotypedata": literal(spark, [], "phenotype_id int, germinatebase_id int, dataset_id int"),
    }
    rejects = load_phenotype_data(trial_cells(trial_sheet(spark, folder)), key_file(spark), tables).rejects
    return rejects.withColumn("phenotype_value", F.col("phenotype_value").cast("double"))


@query(
    "lookup_first_match",
    """
select c_custkey, c_mktsegment, f.first.o_orderkey as first_order, f.first.o_totalprice as first_price
from customer left join (
  select o_custkey, arg_min({'o_orderkey': o_orderkey, 'o_totalprice': o_totalprice}, {'d': o_orderdate, 'k': o_orderkey}) as first
  from orders group by 1) f on f.o_custkey = c_custkey""",
)
def lookup_first_match(spark, folder):
    found = K.lookup(
        table(spark, folder, "customer"), table(spark, folder, "orders"), "c_custkey", "o_custkey",
        {"first_order": "o_orderkey", "first_price": "o_totalprice"}, ["o_orderdate", "o_orderkey"],
    )
    return found.select("c_custkey", "c_mktsegment", "first_order", "first_price")


@query(
    "lookup_null_key",
    """
with dim as (
  select k, arg_min_null({'name': name}, id) as found from (
    select nullif(p_type, 'STANDARD') as k, nullif(p_name, 'red widget') as name, p_partkey as id from part) group by 1)
select l_orderkey, l_linenumber, l_partkey, dim.found.name as first_name
from lineitem join part on l_partkey = p_partkey
left join dim on nullif(p_type, 'STANDARD') is not distinct from dim.k""",
)
def lookup_null_key(spark, folder):
    """A null key finds the null row, and a null value of the first match stays null."""
    parts = table(spark, folder, "part")
    keyed = parts.select(F.nullif("p_type", F.lit("STANDARD")).alias("k"), "p_partkey")
    dim = parts.select(
        F.nullif("p_type", F.lit("STANDARD")).alias("dk"),
        F.nullif("p_name", F.lit("red widget")).alias("name"),
        F.col("p_partkey").alias("id"),
    )
    lines = table(spark, folder, "lineitem").join(keyed, F.col("l_partkey") == F.col("p_partkey"))
    return K.lookup(lines, dim, "k", "dk", {"first_name": "name"}, ["id"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "first_name"
    )


@query(
    "lookup_salted",
    """
select l_orderkey, l_linenumber, l_suppkey, s.low_key from lineitem
left join (select cast(s_nationkey as bigint) as k, min(s_suppkey) as low_key from supplier group by 1) s
  on s.k = (case when l_returnflag = 'N' then 1 else l_linenumber end)""",
)
def lookup_salted(spark, folder):
    """Half of the rows share one key, which is spread over sixteen copies of the dimension."""
    lines = table(spark, folder, "lineitem")
    hot = F.when(F.col("l_returnflag") == "N", F.lit(1)).otherwise(F.col("l_linenumber"))
    found = K.lookup(
        lines, table(spark, folder, "supplier"), hot, "s_nationkey", {"low_key": "s_suppkey"}, ["s_suppkey"], salts=16
    )
    return found.select("l_orderkey", "l_linenumber", "l_suppkey", "low_key")


@query(
    "lookup_fallback",
    """
with dim as (
  select s_suppkey as id, case when s_acctbal > 0 then s_name end as code,
    concat('Customer#', lpad(cast(s_suppkey as varchar), 9, '0')) as name from supplier)
select c_custkey, coalesce(a.id, b.id) as entity_id from customer
left join (select code, min(id) as id from dim group by 1) a
  on a.code = concat('Supplier#', lpad(cast(c_nationkey as varchar), 9, '0')) and c_acctbal > 5000
left join (select name, min(id) as id from dim group by 1) b on b.name = c_name and not c_acctbal > 5000""",
)
def lookup_fallback(spark, folder):
    """One key is tried against two columns of the dimension."""
    suppliers = table(spark, folder, "supplier")
    padded = F.lpad(F.col("s_suppkey").cast("string"), 9, "0")
    dim = suppliers.select(
        F.col("s_suppkey").alias("id"),
        F.when(F.col("s_acctbal") > 0, F.col("s_name")).alias("code"),
        F.concat(F.lit("Customer#"), padded).alias("name"),
    )
    nation = F.lpad(F.col("c_nationkey").cast("string"), 9, "0")
    key = F.when(F.col("c_acctbal") > 5000, F.concat(F.lit("Supplier#"), nation)).otherwise(F.col("c_name"))
    found = K.lookup_fallback(table(spark, folder, "customer"), dim, key, ["code", "name"], "id", "entity_id", ["id"])
    return found.select("c_custkey", "entity_id")


@query(
    "lookup_any_of",
    """
with dim as (
  select k, arg_min_null({'loc': loc, 'inst': inst}, o) as f from (
    select concat('Customer#', lpad(cast(l_suppkey as varchar), 9, '0')) as k,
      case when l_returnflag <> 'A' then l_linenumber end as loc,
      case when l_linestatus = 'F' then 1 else 4 end as inst, {'a': l_orderkey, 'b': l_linenumber, 'c': l_partkey, 'd': l_extendedprice} as o
    from lineitem) group by 1)
select c_custkey, coalesce(a.f.loc, b.f.loc) as loc, coalesce(a.f.inst, b.f.inst) as inst from customer
left join dim a on a.k = c_name
left join dim b on b.k = concat('Customer#', lpad(cast(c_nationkey as varchar), 9, '0'))""",
)
def lookup_any_of(spark, folder):
    """Two left keys are tried for two targets, each target falling back by itself."""
    lines = table(spark, folder, "lineitem").select(
        F.concat(F.lit("Customer#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")).alias("k"),
        F.when(F.col("l_returnflag") != "A", F.col("l_linenumber")).alias("loc"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(4).alias("inst"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
    )
    second = F.concat(F.lit("Customer#"), F.lpad(F.col("c_nationkey").cast("string"), 9, "0"))
    found = K.lookup_any_of(
        table(spark, folder, "customer"), lines, ["c_name", second], "k", {"loc": "loc", "inst": "inst"},
        ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"],
    )
    return found.select("c_custkey", "loc", "inst")


@query(
    "lookup_rekey",
    """
with dim(id, short_name) as (values (1, 'AUTOMOBILE'), (2, 'BUILDING;1'), (3, 'BUILDING;2'), (4, 'MACHINERY;3'))
select c_custkey, coalesce(a.id, b.id) as phenotype_id from customer
left join dim a on a.short_name = c_mktsegment
left join dim b on b.short_name = concat(c_mktsegment, ';', cast(c_nationkey as varchar))""",
)
def lookup_rekey(spark, folder):
    dim = literal(spark, 
        [(1, "AUTOMOBILE"), (2, "BUILDING;1"), (3, "BUILDING;2"), (4, "MACHINERY;3")], "id int, short_name string"
    )
    again = glue("c_mktsegment", F.col("c_nationkey").cast("string"), separator=";")
    found = K.lookup_rekey(
        table(spark, folder, "customer"), dim, "c_mktsegment", again, "short_name", "id", "phenotype_id", ["id"]
    )
    return found.select("c_custkey", "phenotype_id")


@query(
    "lookup_default",
    """
select o_orderkey, n.n_nationkey as stage_id from orders
left join nation n on n.n_name = coalesce(case when o_orderstatus = 'F' then null
  else concat('NATION_', substr(o_orderpriority, 1, 1)) end, 'NATION_24')""",
)
def lookup_default(spark, folder):
    """A missing key finds the row that stands for unknown."""
    orders = table(spark, folder, "orders").withColumn(
        "stage", F.when(F.col("o_orderstatus") != "F", F.concat(F.lit("NATION_"), F.substring("o_orderpriority", 1, 1)))
    )
    found = K.lookup_or_default(
        orders, table(spark, folder, "nation"), "stage", "NATION_24", "n_name", {"stage_id": "n_nationkey"}, ["n_nationkey"]
    )
    return found.select("o_orderkey", "stage_id")


def _absent(name: str, keys: list[str], sql_keys: list[str], before: str):
    match = " and ".join(f"s.{k} is not distinct from n.{k}" for k in keys)
    picked = ", ".join(f"{expression} as {k}" for k, expression in zip(keys, sql_keys))
    sql = f"""
with n as (select {picked}, l_orderkey, l_extendedprice, l_shipdate from lineitem)
select {", ".join(keys)}, l_orderkey, l_extendedprice from n
where not exists (select 1 from n s where s.l_shipdate < date '{before}' and {match})"""

    @query(name, sql)
    def run(spark, folder):
        lines = table(spark, folder, "lineitem").select(
            *[F.expr(expression).alias(k) for k, expression in zip(keys, sql_keys)],
            "l_orderkey", "l_extendedprice", "l_shipdate",
        )
        stored = lines.where(F.col("l_shipdate") < F.lit(before).cast("timestamp_ntz"))
        return K.only_new(lines, stored, keys).select(*keys, "l_orderkey", "l_extendedprice")

    return run


# Few lines were shipped before the first date, so keys are found on both sides at every scale.
_absent("append_if_absent_one_key", ["part_key"], ["nullif(l_partkey, 7)"], "1995-01-20")
_absent(
    "append_if_absent_two_keys", ["part_key", "flag"], ["l_partkey", "nullif(l_returnflag, 'N')"], LOADED_BEFORE
)
_absent(
    "append_if_absent_three_keys",
    ["supplier_key", "flag", "line"],
    ["nullif(l_suppkey, 5)", "nullif(l_returnflag, 'A')", "l_linenumber"],
    "1995-01-20",
)


@query(
    "only_known",
    """
select doc_id, lang, source, n_chars from documents d
where exists (select 1 from labels l where l.doc_id = d.doc_id and l.quality = 1)""",
)
def only_known(spark, folder):
    good = table(spark, folder, "labels").where(F.col("quality") == 1)
    return K.only_known(table(spark, folder, "documents"), good, ["doc_id"]).select(
        "doc_id", "lang", "source", "n_chars"
    )


@query(
    "denormalise",
    """
with fact as (select l_partkey, l_suppkey, sum(l_quantity) as quantity from lineitem group by 1, 2),
p as (select p_partkey as id, p_name as name, p_brand as brand from part where p_size <= 25),
s as (select s_suppkey as id, s_name as name from supplier where s_acctbal > 0),
one as (select coalesce(f.l_partkey, p.id) as l_partkey, l_suppkey, quantity, name, brand
  from fact f full join p on f.l_partkey is not distinct from p.id),
two as (select l_partkey, coalesce(o.l_suppkey, s.id) as l_suppkey, quantity, o.name, brand, s.name as name_supplier
  from one o full join s on o.l_suppkey is not distinct from s.id)
select l_partkey, l_suppkey, round(quantity, 2) as quantity, name, brand, name_supplier from two""",
)
def denormalise(spark, folder):
    """Full joins keep unmatched rows of both sides; a clashing name gets a suffix."""
    fact = table(spark, folder, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.sum("l_quantity").alias("quantity"))
    parts = table(spark, folder, "part").where("p_size <= 25").selectExpr("p_partkey as id", "p_name as name", "p_brand as brand")
    suppliers = table(spark, folder, "supplier").where("s_acctbal > 0").selectExpr("s_suppkey as id", "s_name as name")
    joined = K.denormalise(fact, [("l_partkey", "_part", parts), ("l_suppkey", "_supplier", suppliers)])
    return joined.withColumn("quantity", F.round("quantity", 2))


@query(
    "one_to_many",
    """
select n_nationkey, n_name, s_suppkey, s_acctbal from nation left join supplier on s_nationkey = n_nationkey""",
)
def one_to_many(spark, folder):
    return K.one_to_many(table(spark, folder, "nation"), table(spark, folder, "supplier"), "n_nationkey", "s_nationkey").select(
        "n_nationkey", "n_name", "s_suppkey", "s_acctbal"
    )


@query(
    "inner_filter",
    """
select o_orderkey, c_custkey, c_mktsegment from orders join customer on o_custkey = c_custkey
where c_mktsegment = 'BUILDING'""",
)
def inner_filter(spark, folder):
    joined = table(spark, folder, "orders").join(
        table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"), "inner"
    )
    return joined.where(F.col("c_mktsegment") == "BUILDING").select("o_orderkey", "c_custkey", "c_mktsegment")


TURNS_SQL = """turns as (
  select conv_id * 1000 + turn as id, concat('c', cast(conv_id as varchar), ':', cast(turn as varchar)) as general_identifier,
    case when turn > 0 then concat('c', cast(conv_id as varchar), ':', cast(turn - 1 as varchar)) end as parent,
    role, turn from conversations)"""


def _turns(spark, folder):
    name = lambda turn: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit(":"), turn.cast("string"))
    return table(spark, folder, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"),
        name(F.col("turn")).alias("general_identifier"),
        F.when(F.col("turn") > 0, name(F.col("turn") - 1)).alias("parent"),
        "role", "turn",
    )


@query(
    "resolve_parent",
    f"""
with {TURNS_SQL}
select t.id, t.role, p.id as entityparent_id from turns t
left join (select general_identifier, min(id) as id from turns group by 1) p on p.general_identifier = t.parent""",
)
def resolve_parent(spark, folder):
    return K.resolve_parent(_turns(spark, folder), "parent").select("id", "role", "entityparent_id")


@query(
    "parent_precedence",
    f"""
with {TURNS_SQL}, keyed as (
  select id, coalesce(case when role = 'assistant' then parent end, case when turn > 1 then general_identifier end) as parent_key
  from turns)
select k.id, parent_key, p.id as entityparent_id from keyed k
left join (select general_identifier, min(id) as id from turns group by 1) p on p.general_identifier = k.parent_key
where parent_key is not null""",
)
def parent_precedence(spark, folder):
    """The first filled candidate is the parent; rows without one are left out."""
    turns = _turns(spark, folder)
    marked = turns.withColumns(
        {
            "first_choice": F.when(F.col("role") == "assistant", F.col("parent")),
            "second_choice": F.when(F.col("turn") > 1, F.col("general_identifier")),
        }
    )
    keyed = K.parent_key(marked, ["first_choice", "second_choice"], required=True)
    return K.resolve_parent(keyed, "parent_key", source=turns).select("id", "parent_key", "entityparent_id")


@query(
    "number_rows",
    """
select status, y, cast(row_number() over (order by y, status) + 22 as integer) as experiment_id
from (select distinct o_orderstatus as status, cast(year(o_orderdate) as integer) as y from orders)""",
)
def number_rows_query(spark, folder):
    kinds = table(spark, folder, "orders").select(F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("y"))
    return number_rows(kinds.distinct(), ["y", "status"], "experiment_id", 22)


@query(
    "assign_ids",
    "with src as (select l_partkey as part_key, l_suppkey as supplier_key, l_returnflag as flag from lineitem)\n"
    + numbered_sql(["part_key", "supplier_key", "flag"], "src", "(select max(s_suppkey) from supplier)"),
)
def assign_ids_query(spark, folder):
    """Every line gets the next free id; equal lines get consecutive ones."""
    lines = table(spark, folder, "lineitem").selectExpr("l_partkey as part_key", "l_suppkey as supplier_key", "l_returnflag as flag")
    return assign_ids(lines, table(spark, folder, "supplier").selectExpr("s_suppkey as id"))
