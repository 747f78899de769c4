"""Load jobs and views, fed by driver tables in the shape of sheets."""

from __future__ import annotations

from pyspark.sql import functions as F

from plotloom.literals import literal
from plotloom.operators.reshape import to_long, to_wide
from plotloom.plans import entities as E
from plotloom.plans import trials as T
from plotloom.plans import views as V
from plotloom.plans.vocabularies import VOCABULARIES, load_vocabulary
from plotloom.queries.base import (
    CELLS_SQL,
    DATASETS_SQL,
    ENTITIES_SQL,
    KEY_FILE_SQL,
    LOCATIONS_SQL,
    TRIAL_SQL,
    datasets,
    entities,
    key_file,
    locations,
    numbered_sql,
    query,
    rounded,
    table,
    trial_cells,
    trial_sheet,
)
from plotloom.queries.columns import ACCESSION_SQL, accessions

AS_OF = "2020-01-01"

# Vocabularies ----------------------------------------------------------------------------

WORD = "case p_type when 'STANDARD' then 'SNP' when 'PROMO' then 'KASP' when 'ECONOMY' then 'CC-BY' else p_type end"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _register_vocabulary(target: str) -> None:
    rows, schema, key = VOCABULARIES[target]
    columns = [part.split()[0] for part in schema.split(", ")]
    values = ", ".join("(" + ", ".join(map(_text, row)) + ")" for row in rows)
    sql = f"""
with stored as (select min(p_partkey) as id, {WORD} as {key} from part group by 2),
words({", ".join(columns)}) as (values {values}),
fresh as (select * from words where {key} not in (select {key} from stored))
{numbered_sql(columns, "fresh", "(select max(id) from stored)")}"""

    @query(f"load_{target}", sql)
    def run(spark, folder):
        stored = table(spark, folder, "part").groupBy(F.expr(WORD).alias(key)).agg(F.min("p_partkey").alias("id"))
        return load_vocabulary(target, stored).new_rows


for _target in VOCABULARIES:
    _register_vocabulary(_target)


# Markers ---------------------------------------------------------------------------------

GENOTYPE_SQL = """geno as (
  select concat('2016_Obregon_', p_type, '_GBS.csv') as file, concat(p_brand, '|', p_name) as allele, p_partkey, p_size,
    nullif(p_type, 'PROMO') as chrom, p_size as pos, nullif(p_size, 3) as shift from part)"""


def genotypes(spark, folder):
    return table(spark, folder, "part").select(
        F.concat(F.lit("2016_Obregon_"), "p_type", F.lit("_GBS.csv")).alias("file"),
        F.concat("p_brand", F.lit("|"), "p_name").alias("AlleleID"),
        F.nullif("p_type", F.lit("PROMO")).alias(T.CHROMOSOME), F.col("p_size").alias(T.POSITION),
        F.lit("A>G").alias("SNP"), F.nullif("p_size", F.lit(3)).alias(T.OFFSET), "p_partkey", "p_size",
    )


def markers(spark, folder, where="true"):
    return genotypes(spark, folder).where(where).groupBy(F.col("AlleleID").alias("marker_name")).agg(
        F.min("p_partkey").alias("id")
    )


@query(
    "load_markers",
    f"""
with {GENOTYPE_SQL}, stored as (select allele as marker_name, min(p_partkey) as id from geno where p_size <= 10 group by 1),
fresh as (select allele as marker_name, 1 as markertype_id from geno where allele not in (select marker_name from stored))
{numbered_sql(["marker_name", "markertype_id"], "fresh", "(select max(id) from stored)")}""",
)
def load_markers(spark, folder):
    tables = {"markers": markers(spark, folder, "p_size <= 10")}
    return T.load_markers(genotypes(spark, folder), tables).new_rows


@query(
    "load_mapdefinitions",
    f"""
with {GENOTYPE_SQL}, m as (select allele, min(p_partkey) as id from geno group by 1),
stored as (select distinct p_partkey as marker_id from geno where p_size > 40)
select 1 as mapfeaturetype_id, m.id as marker_id, 1 as map_id, pos as definition_start, pos + shift as definition_end,
  coalesce(chrom, 'Unmapped') as chromosome
from geno join m on m.allele = geno.allele where m.id not in (select marker_id from stored)""",
)
def load_mapdefinitions(spark, folder):
    stored = genotypes(spark, folder).where("p_size > 40").select(F.col("p_partkey").alias("marker_id"))
    tables = {"markers": markers(spark, folder), "mapdefinitions": stored}
    return T.load_map_definitions(genotypes(spark, folder), tables).new_rows


# Groups ----------------------------------------------------------------------------------

GROUPS_SQL = """grp as (
  select cast(min(n_nationkey) as integer) as id, concat('Panel ', cast(n_regionkey as varchar)) as name from nation group by 2
  union all select id + 100, site_name_short from locations where id < 3
  union all select distinct 200, 'PROMO GBS' from part where p_type = 'PROMO'
  union all select distinct 201, 'ECONOMY GBS' from part where p_type = 'ECONOMY')"""


def groups(spark, folder):
    panels = table(spark, folder, "nation").groupBy(
        F.concat(F.lit("Panel "), F.col("n_regionkey").cast("string")).alias("name")
    ).agg(F.min("n_nationkey").alias("id"))
    sites = locations(spark).where("id < 3").select(F.col("site_name_short").alias("name"), (F.col("id") + 100).alias("id"))
    kinds = table(spark, folder, "part").where(F.col("p_type").isin("PROMO", "ECONOMY")).select(
        F.concat("p_type", F.lit(" GBS")).alias("name"), F.when(F.col("p_type") == "PROMO", 200).otherwise(201).alias("id")
    ).distinct()
    return panels.unionByName(sites).unionByName(kinds)


def members(spark, folder):
    return table(spark, folder, "supplier").where("s_acctbal > 5000").select(
        F.col("s_suppkey").cast("int").alias("foreign_id"), F.col("s_nationkey").alias("group_id")
    )


MEMBERS_SQL = "mem as (select cast(s_suppkey as integer) as foreign_id, s_nationkey as group_id from supplier where s_acctbal > 5000)"
GROUP_COLUMNS = ["name", "description", "visibility", "grouptype_id"]


@query(
    "load_panel_groups",
    f"""
with {TRIAL_SQL}, {LOCATIONS_SQL}, {GROUPS_SQL}, fresh as (
  select distinct "Panel" as name, 'Accession panel' as description, 1 as visibility, 3 as grouptype_id from trial
  where "Panel" not in (select name from grp))
{numbered_sql(GROUP_COLUMNS, "fresh", "(select max(id) from grp)")}""",
)
def load_panel_groups(spark, folder):
    return T.load_panel_groups(trial_sheet(spark, folder), {"groups": groups(spark, folder)}).new_rows


SITE_SQL = """sites as (
  select distinct case when split_part(file, '_', 2) = 'GES' then
      case when split_part(file, '_', 1) = '2017' then 'GES CR04' else 'GES VR11' end else 'Obregon' end as site from trial)"""


@query(
    "load_site_groups",
    f"""
with {TRIAL_SQL}, {LOCATIONS_SQL}, {GROUPS_SQL}, {SITE_SQL}, fresh as (
  select site as name, 'Trial location' as description, 1 as visibility, 4 as grouptype_id from sites
  where site not in (select name from grp))
{numbered_sql(GROUP_COLUMNS, "fresh", "(select max(id) from grp)")}""",
)
def load_site_groups(spark, folder):
    return T.load_site_groups(trial_sheet(spark, folder), {"groups": groups(spark, folder)}).new_rows


PANEL_PAIR_SQL = f"""{TRIAL_SQL}, {LOCATIONS_SQL}, {GROUPS_SQL}, {ENTITIES_SQL}, {MEMBERS_SQL},
pairs as (
  select distinct coalesce(e1.id, e2.id) as foreign_id, grp.id as group_id
  from (select distinct "ID", "Panel" from trial) t
  left join entities e1 on e1.general_identifier = t."ID" left join entities e2 on e2.name = t."ID"
  left join grp on grp.name = t."Panel")"""


def _panel_member_tables(spark, folder):
    return {"germinatebase": entities(spark, folder), "groups": groups(spark, folder), "groupmembers": members(spark, folder)}


@query(
    "load_panel_members",
    f"""
with {PANEL_PAIR_SQL}
select foreign_id, group_id from pairs p where group_id is not null and foreign_id is not null
  and not exists (select 1 from mem where mem.foreign_id = p.foreign_id and mem.group_id = p.group_id)""",
)
def load_panel_members(spark, folder):
    return T.load_panel_members(trial_sheet(spark, folder), _panel_member_tables(spark, folder)).new_rows


@query(
    "load_panel_members_narrow_key",
    f"""
with {PANEL_PAIR_SQL}
select foreign_id, group_id from pairs p where foreign_id is not null and foreign_id not in (select foreign_id from mem)""",
)
def load_panel_members_narrow_key(spark, folder):
    """The same with the member id alone as key; unknown panels stay in."""
    tables = _panel_member_tables(spark, folder)
    return T.load_panel_members(trial_sheet(spark, folder), tables, ["foreign_id"]).new_rows


@query(
    "load_site_members",
    f"""
with {TRIAL_SQL}, {LOCATIONS_SQL}, {GROUPS_SQL}, {SITE_SQL}, {MEMBERS_SQL},
pairs as (select l.id as foreign_id, grp.id as group_id from sites
  left join locations l on l.site_name_short = site left join grp on grp.name = site)
select foreign_id, group_id from pairs p where foreign_id is not null and group_id is not null
  and not exists (select 1 from mem where mem.foreign_id = p.foreign_id and mem.group_id = p.group_id)""",
)
def load_site_members(spark, folder):
    tables = {"locations": locations(spark), "groups": groups(spark, folder), "groupmembers": members(spark, folder)}
    return T.load_site_members(trial_sheet(spark, folder), tables).new_rows


@query(
    "load_genotype_groups",
    f"""
with {GENOTYPE_SQL}, {LOCATIONS_SQL}, {GROUPS_SQL}, fresh as (
  select distinct concat(split_part(file, '_', 3), ' GBS') as name, 'Genotyping dataset' as description, 1 as visibility,
    2 as grouptype_id from geno where concat(split_part(file, '_', 3), ' GBS') not in (select name from grp))
{numbered_sql(GROUP_COLUMNS, "fresh", "(select max(id) from grp)")}""",
)
def load_genotype_groups(spark, folder):
    return T.load_genotype_groups(genotypes(spark, folder), {"groups": groups(spark, folder)}).new_rows


@query(
    "load_marker_members",
    f"""
with {GENOTYPE_SQL}, {LOCATIONS_SQL}, {GROUPS_SQL}, {MEMBERS_SQL}, m as (select allele, min(p_partkey) as id from geno group by 1),
pairs as (select distinct m.id as foreign_id, grp.id as group_id from geno join m on m.allele = geno.allele
  left join grp on grp.name = concat(split_part(file, '_', 3), ' GBS'))
select foreign_id, group_id from pairs p where group_id is not null
  and not exists (select 1 from mem where mem.foreign_id = p.foreign_id and mem.group_id = p.group_id)""",
)
def load_marker_members(spark, folder):
    tables = {"markers": markers(spark, folder), "groups": groups(spark, folder), "groupmembers": members(spark, folder)}
    return T.load_marker_members(genotypes(spark, folder), tables).new_rows


# Experiments, entities, data sets --------------------------------------------------------

KIND = (
    "case substr(o_orderpriority, 1, 1) when '1' then 'Metabolomics-metabolite' when '2' then 'Proteomics-peptide'"
    " else 'Proteomics-functionalbin' end"
)
COMPOUND_FILE = f"concat('2016_GES_trial_', {KIND}, '.csv')"
EXPERIMENT = (
    "case when year(o_orderdate) = 1998 then 'Obregon2016_trial'"
    " else concat('GES', cast(year(o_orderdate) + 18 as varchar(4)), '_trial') end"
)


def compound_rows(spark, folder):
    """Two cells per order, one of them empty where the order is pending."""
    orders = table(spark, folder, "orders").select(
        F.expr(COMPOUND_FILE).alias("file"), F.expr(EXPERIMENT).alias("experiment_name"), "o_orderkey",
        F.col("o_totalprice").alias("s1"), F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("s2"),
    )
    placed = orders.withColumn("place", F.struct("file", (-F.col("o_orderkey")).alias("line")))
    return to_long(placed, ["file", "place", "experiment_name"], ["s1", "s2"])


@query(
    "load_compound_experiments",
    f"""
with seen as (
  select {EXPERIMENT} as name, {KIND} as type, max({{'f': {COMPOUND_FILE}, 'o': -o_orderkey}}) as place from orders
  where o_orderstatus <> 'P' group by 1, 2),
numbered as (
  select concat('IW_E00', cast(row_number() over (order by place desc, type) + 22 as varchar)) as experiment_name,
    concat(case when name = 'Obregon2016_trial' then 'CIMMYT2016' else concat('GES', substr(name, 6)) end, ' ', type) as description,
    6 as experiment_type_id from seen),
stored as (select 10 as id, concat('GES', substr(cast(min(year(o_orderdate)) + 18 as varchar), 3), '_trial Proteomics-peptide') as description from orders),
fresh as (select * from numbered where description not in (select description from stored))
{numbered_sql(["experiment_name", "description", "experiment_type_id"], "fresh", "10")}""",
)
def load_compound_experiments(spark, folder):
    stored = table(spark, folder, "orders").agg(F.min(F.year("o_orderdate")).alias("y")).select(
        F.lit(10).alias("id"),
        F.concat(F.lit("GES"), F.substring((F.col("y") + 18).cast("string"), 3, 2), F.lit("_trial Proteomics-peptide")).alias("description"),
    )
    return T.load_compound_experiments(compound_rows(spark, folder), {"experiments": stored}).new_rows


@query(
    "refresh_entities",
    f"""
with {TRIAL_SQL}, {LOCATIONS_SQL}, {ENTITIES_SQL}, last as (select "ID", max(file) as file from trial group by 1),
sited as (
  select "ID", case when split_part(file, '_', 2) = 'GES' then
      case when split_part(file, '_', 1) = '2017' then 'GES CR04' else 'GES VR11' end else 'Obregon' end as site from last),
placed as (select sited."ID" as code, l.id as location_id, case when site = 'Obregon' then 4 else 1 end as institution_id
  from sited left join locations l on l.site_name_short = site)
select e.id, e.general_identifier, e.number, e.name, e.entitytype_id,
  coalesce(a.location_id, b.location_id, c.location_id) as location_id,
  coalesce(a.institution_id, b.institution_id, c.institution_id) as institution_id
from entities e left join placed a on a.code = e.general_identifier left join placed b on b.code = e.number
left join placed c on c.code = e.name""",
)
def refresh_entities(spark, folder):
    tables = {"locations": locations(spark), "germinatebase": entities(spark, folder)}
    return T.refresh_entities(trial_sheet(spark, folder), tables)


DATASET_COLUMNS = [
    "experiment_id", "location_id", "description", "source_file", "datatype", "version", "created_by",
    "dataset_state_id", "contact",
]


@query(
    "load_datasets",
    f"""
with {TRIAL_SQL}, {LOCATIONS_SQL}, {DATASETS_SQL},
files as (select distinct file from trial union select distinct {COMPOUND_FILE} from orders),
parts as (select file, split_part(file, '_', 1) as year, split_part(file, '_', 2) as site, split_part(file, '_', 3) as t,
    replace(split_part(file, '_', 4), '.csv', '') as datatype from files),
described as (select *, case when concat(site, year, '_', t) = 'Obregon2016_trial' then 'CIMMYT2016'
    when site = 'GES' then concat('GES', substr(year, 3), '_', t) else concat(site, year, '_', t) end as d,
    case when site = 'GES' then case when year = '2017' then 'GES CR04' else 'GES VR11' end else site end as s from parts),
experiments(id, description) as (values (1, 'GES17_trial'), (2, 'CIMMYT2016'), (3, 'GES16_trial Proteomics-peptide')),
fresh as (
  select x.id as experiment_id, l.id as location_id, concat(d, ' ', datatype) as description, file as source_file, datatype,
    cast(0.1 as double) as version, 1 as created_by, 2 as dataset_state_id, 'trial office' as contact
  from described left join experiments x on x.description = case when datatype like '%omics-%' then concat(d, ' ', datatype) else d end
  left join locations l on l.site_name_short = s
  where concat(d, ' ', datatype) not in (select description from datasets where id < 20160))
{numbered_sql(DATASET_COLUMNS, "fresh", "(select max(id) from datasets where id < 20160)")}""",
)
def load_datasets(spark, folder):
    from plotloom.functions.domain import file_name_parts

    compounds = table(spark, folder, "orders").select(F.expr(COMPOUND_FILE).alias("file"))
    files = file_name_parts(trial_sheet(spark, folder).select("file").unionByName(compounds).distinct())
    tables = {
        "experiments": literal(spark, 
            [(1, "GES17_trial"), (2, "CIMMYT2016"), (3, "GES16_trial Proteomics-peptide")], "id int, description string"
        ),
        "locations": locations(spark),
        "datasets": datasets(spark, folder).where("id < 20160"),
    }
    return T.load_datasets(files, tables, "trial office").new_rows


@query(
    "load_dataset_members",
    f"""with {DATASETS_SQL} select id as dataset_id, 2 as datasetmembertype_id from datasets where id >= 20160""",
)
def load_dataset_members(spark, folder):
    every = datasets(spark, folder)
    stored = every.where("id < 20160").select(F.col("id").alias("dataset_id"))
    return T.load_dataset_members({"datasets": every, "datasetmembers": stored}).new_rows


@query(
    "load_dataset_permissions",
    f"""with {DATASETS_SQL} select id as dataset_id, 1 as user_id, 1 as group_id from datasets where id >= 20150""",
)
def load_dataset_permissions(spark, folder):
    every = datasets(spark, folder)
    stored = every.where("id < 20150").select(F.col("id").alias("dataset_id"))
    return T.load_dataset_permissions({"datasets": every, "datasetpermissions": stored}).new_rows


# Compounds -------------------------------------------------------------------------------

PART_KIND = "case p_type when 'PROMO' then 'Metabolomics-metabolite' when 'ECONOMY' then 'Proteomics-peptide' else 'Proteomics-functionalbin' end"
PART_NAME = "concat('Part ', cast(p_partkey as varchar(20)), case when p_size < 10 then ' Elke' when p_size < 20 then ' new' else '' end)"


@query(
    "load_compounds",
    f"""
with rows as (select concat('Part ', cast(p_partkey as varchar)) as name, {PART_KIND} as k, p_size from part),
fresh as (select split_part(k, '-', 1) as description, name, split_part(k, '-', 2) as compound_class, 1 as unit_id from rows where p_size >= 5)
{numbered_sql(["description", "name", "compound_class", "unit_id"], "fresh", "(select max(p_partkey) from part where p_size < 5)")}""",
)
def load_compounds(spark, folder):
    parts = table(spark, folder, "part")
    rows = parts.select(
        F.expr(f"concat('2016_Obregon_trial_', {PART_KIND}, '.csv')").alias("file"), F.expr(PART_NAME).alias("compound")
    )
    stored = parts.where("p_size < 5").select(
        F.col("p_partkey").alias("id"), F.concat(F.lit("Part "), F.col("p_partkey").cast("string")).alias("name")
    )
    return T.load_compounds(rows, {"compounds": stored}).new_rows


LINE_KIND = "case l_returnflag when 'A' then 'Harvest' when 'N' then 'Lidar' else 'Q2' end"


def compound_cells(spark, folder):
    """Line items as compound values; the data types are those of the data sets at hand."""
    return table(spark, folder, "lineitem").select(
        F.expr(
            "concat(cast(year(l_shipdate) + 18 as string), '_', if(l_linestatus = 'F', 'GES', 'Obregon'), '_trial_', "
            + LINE_KIND + ", '.csv')"
        ).alias("file"),
        F.concat(F.lit("Part "), F.col("l_partkey").cast("string"), F.when(F.col("l_linenumber") > 3, " new").otherwise(" Elke")).alias("compound"),
        F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")).alias("name"),
        F.col("l_extendedprice").cast("string").alias("value"),
        "l_shipdate",
    )


COMPOUND_DATA_SQL = f"""{DATASETS_SQL}, {ENTITIES_SQL}, parts as (
  select l_partkey, l_suppkey, l_extendedprice, l_shipdate, case when l_linestatus = 'F' then 'GES' else 'Obregon' end as site,
    cast(year(l_shipdate) + 18 as varchar) as y, {LINE_KIND} as k from lineitem),
linked as (
  select p.p_partkey as compound_id, e.id as germinatebase_id, d.id as dataset_id, l_extendedprice as compound_value, l_shipdate
  from parts left join part p on p.p_partkey = l_partkey and p.p_size > 5
  left join entities e on e.general_identifier = concat('Supplier#', lpad(cast(l_suppkey as varchar), 9, '0'))
  left join datasets d on d.description = concat(case when site = 'GES' then concat('GES', substr(y, 3), '_trial')
    when y = '2016' then 'CIMMYT2016' else concat('Obregon', y, '_trial') end, ' ', k))"""


def _compound_tables(spark, folder):
    compounds = table(spark, folder, "part").where("p_size > 5").select(
        F.col("p_partkey").alias("id"), F.concat(F.lit("Part "), F.col("p_partkey").cast("string")).alias("name")
    )
    return {
        "compounds": compounds,
        "germinatebase": entities(spark, folder),
        "datasets": datasets(spark, folder),
        "compounddata": literal(spark, [], "compound_id long, germinatebase_id int, dataset_id int"),
    }


@query(
    "load_compounddata",
    f"""
with {COMPOUND_DATA_SQL}, stored as (
  select distinct compound_id, germinatebase_id, dataset_id from linked where l_shipdate < date '1997-01-01')
select compound_id, germinatebase_id, dataset_id, compound_value from linked x
where compound_id is not null and germinatebase_id is not null and dataset_id is not null and not exists (
  select 1 from stored s where s.compound_id = x.compound_id and s.germinatebase_id = x.germinatebase_id and s.dataset_id = x.dataset_id)""",
)
def load_compounddata(spark, folder):
    cells = compound_cells(spark, folder)
    tables = _compound_tables(spark, folder)
    earlier = cells.where(F.col("l_shipdate") < F.lit("1997-01-01").cast("timestamp_ntz"))
    stored = T.load_compound_data(earlier, tables).new_rows
    tables["compounddata"] = stored.select("compound_id", "germinatebase_id", "dataset_id")
    return T.load_compound_data(cells, tables).new_rows


# Units and phenotypes ----------------------------------------------------------------------

UNIT_FILE = [("kg", "kilogram", "mass"), ("usd", "dollar", "money"), ("mm", "millimetre", "length")]


@query(
    "load_units",
    f"""
with {TRIAL_SQL}, {CELLS_SQL}, {KEY_FILE_SQL},
unit_file(a, n, d) as (values ('kg', 'kilogram', 'mass'), ('usd', 'dollar', 'money'), ('mm', 'millimetre', 'length')),
used as (select distinct split_part(name, '_', 2) as unit_abbreviation from cells
  where split_part(name, '_', 1) in (select short_name from key_file)),
fresh as (select unit_abbreviation, n as unit_name, d as unit_description from used left join unit_file on a = unit_abbreviation
  where unit_abbreviation not in (select lower(r_name) from region where r_regionkey = 0) and unit_abbreviation <> 'usd')
{numbered_sql(["unit_abbreviation", "unit_name", "unit_description"], "fresh", "(select max(r_regionkey) from region)")}""",
)
def load_units(spark, folder):
    """One unit is known already, one has no entry in the unit file."""
    unit_file = literal(spark, UNIT_FILE, "unit_abbreviation string, unit_name string, unit_description string")
    stored = table(spark, folder, "region").select(
        F.col("r_regionkey").alias("id"), F.when(F.col("r_regionkey") == 1, "usd").otherwise(F.lower("r_name")).alias("unit_abbreviation")
    )
    cells = trial_cells(trial_sheet(spark, folder))
    return T.load_units(cells, key_file(spark), unit_file, {"units": stored}).new_rows


@query(
    "load_phenotypes",
    f"""
with {TRIAL_SQL}, {CELLS_SQL}, {KEY_FILE_SQL}, units(id, a) as (values (13, 'kg'), (2, 'pct')),
traits as (select distinct split_part(name, '_', 1) as s, split_part(name, '_', 2) as u, nullif(split_part(name, '_', 3), '') as m from cells),
fresh as (
  select case when m is null then k.name else concat(k.name, ';', m) end as name, case when m is null then s else concat(s, ';', m) end as short_name,
    k.description, case when units.id = 13 then 'int' when units.id is not null then 'float' else '' end as datatype,
    coalesce(cast(units.id as varchar), '') as unit_id
  from traits join key_file k on k.short_name = s left join units on a = u)
{numbered_sql(["name", "short_name", "description", "datatype", "unit_id"], "(select * from fresh where short_name <> 'share;m2')", "(select max(s_suppkey) from supplier)")}""",
)
def load_phenotypes(spark, folder):
    units = literal(spark, [(13, "kg"), (2, "pct")], "id int, unit_abbreviation string")
    stored = table(spark, folder, "supplier").agg(F.max("s_suppkey").alias("id")).select(
        "id", F.lit("Share;m2").alias("name"), F.lit("share;m2").alias("short_name")
    )
    cells = trial_cells(trial_sheet(spark, folder))
    return T.load_phenotypes(cells, key_file(spark), {"units": units, "phenotypes": stored}).new_rows


# Entity tree -------------------------------------------------------------------------------

BASE_SQL = """base as (
  select s_suppkey as id, concat('Customer#', lpad(cast(s_suppkey as varchar), 9, '0')) as general_identifier,
    cast(null as bigint) as entityparent_id from supplier where s_acctbal > 0)"""


def base(spark, folder):
    return table(spark, folder, "supplier").where("s_acctbal > 0").select(
        F.col("s_suppkey").alias("id"),
        F.concat(F.lit("Customer#"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0")).alias("general_identifier"),
        F.lit(None).cast("long").alias("entityparent_id"),
    )


ACCESSION_COLUMNS = ["name", "general_identifier", "number", "entitytype_id", "biologicalstatus_id", "taxonomy_id", "created_on"]


@query(
    "load_accessions",
    f"""
with {ACCESSION_SQL}, {BASE_SQL}, fresh as (
  select "Accession_name" as name, "Accession_ID" as general_identifier, "Accession_ID" as number, 1 as entitytype_id,
    400 as biologicalstatus_id, 1 as taxonomy_id, '{AS_OF}' as created_on from accession
  where "Accession_ID" not in (select general_identifier from base))
{numbered_sql(ACCESSION_COLUMNS, "fresh", "(select max(id) from base)")}""",
)
def load_accessions(spark, folder):
    return E.load_accessions(accessions(spark, folder), {"germinatebase": base(spark, folder)}, AS_OF).new_rows


@query(
    "accession_parents",
    f"""
with {ACCESSION_SQL}, {BASE_SQL}
select b.id, b.general_identifier, p.id as entityparent_id from base b
left join accession a on a."Accession_ID" = b.general_identifier left join base p on p.general_identifier = a."Parent_ID\"""",
)
def accession_parents(spark, folder):
    return E.accession_parents(accessions(spark, folder), base(spark, folder))


ATTRIBUTE_UNION = " union all ".join(
    f"select \"Accession_ID\" as k, {E.ATTRIBUTE_IDS[name]} as attribute_id, \"{name}\" as value from accession where \"{name}\" is not null"
    for name in E.ACCESSION_ATTRIBUTES
)


@query(
    "accession_attributes",
    f"""
with {ACCESSION_SQL}, {BASE_SQL}, long as ({ATTRIBUTE_UNION}),
stored as (select 3 as attribute_id, id as foreign_id, 'N1' as value from base)
select attribute_id, base.id as foreign_id, value, '{AS_OF}' as created_on from long join base on base.general_identifier = k
where not exists (select 1 from stored s where s.attribute_id = long.attribute_id and s.foreign_id = base.id and s.value = long.value)""",
)
def accession_attributes(spark, folder):
    stored = base(spark, folder).select(F.lit(3).alias("attribute_id"), F.col("id").alias("foreign_id"), F.lit("N1").alias("value"))
    tables = {"germinatebase": base(spark, folder), "attributedata": stored}
    return E.accession_attributes(accessions(spark, folder), tables, AS_OF).new_rows


@query(
    "load_experiments",
    f"""
with fresh as (
  select n_name as experiment_name, concat('Trial ', cast(n_regionkey as varchar)) as description, 3 as experiment_type_id,
    '{AS_OF}' as created_on from nation where n_regionkey <> 2 and n_nationkey > 4)
{numbered_sql(["experiment_name", "description", "experiment_type_id", "created_on"], "fresh", "4")}""",
)
def load_experiments(spark, folder):
    nations = table(spark, folder, "nation")
    sheet = nations.select(
        F.col("n_name").alias("Experiment_ID"), F.col("n_nationkey").alias("row"),
        F.when(F.col("n_regionkey") != 2, F.concat(F.lit("Trial "), F.col("n_regionkey").cast("string"))).alias("Experiment_Name"),
    )
    stored = nations.where("n_nationkey <= 4").selectExpr("n_nationkey as id", "n_name as experiment_name")
    return E.load_experiments(sheet, {"experiments": stored}, AS_OF).new_rows


SHEET_SQL = """sheet as (
  select concat('O', cast(o_orderkey as varchar)) as id_text, o_orderkey as row, o_orderpriority as priority, o_orderstatus as status,
    case when substr(o_orderpriority, 1, 1) <> '1' then concat('Customer#', lpad(cast(o_custkey as varchar), 9, '0')) end as accession,
    case when o_orderstatus = 'F' then 'at Obregon' when o_orderstatus = 'O' then 'GES17 and Birdcage' end as place,
    case when o_orderstatus = 'P' then 'Surplus Sample Number' when o_orderstatus = 'F' then 'kept' end as notes,
    case when o_orderstatus = 'F' and o_orderkey > 0 then concat('O', cast(o_orderkey - 1 as varchar)) end as parent from orders)"""


def order_sheet(spark, folder):
    """Orders as rows of the plot, sample and grain sheets."""
    status, code, key = F.col("o_orderstatus"), F.substring("o_orderpriority", 1, 1), F.col("o_orderkey")
    text = F.concat(F.lit("O"), key.cast("string"))
    accession = F.when(code != "1", F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")))
    return table(spark, folder, "orders").select(
        text.alias("PlantPlot_ID"), text.alias("Sample_ID"), F.concat(F.lit("G"), text).alias("GrainPacket_ID"),
        key.alias("row"), accession.alias("Accession_ID"), accession.alias("Plot_Of"),
        F.nullif("o_orderstatus", F.lit("P")).alias("PlantPlot_Name"), F.col("o_orderpriority").alias("Accession_Name"),
        F.when(status == "F", "at Obregon").when(status == "O", "GES17 and Birdcage").alias("Experiment_Location"),
        F.nullif("o_orderstatus", F.lit("O")).alias("Sample_Name"), F.col("o_orderpriority").alias("Plant_Name"),
        F.when(status == "P", "Surplus Sample Number").when(status == "F", "kept").alias("Notes"),
        F.when((status == "F") & (key > 0), F.concat(F.lit("O"), (key - 1).cast("string"))).alias("Parent_ID"),
        F.when(code == "2", "Frozen Leaf").when(code == "3", "DNA").alias("Sample_Type"),
        F.when(code == "4", "Metabolomics").alias("Purpose"),
        F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("Stage"), F.nullif("o_orderstatus", F.lit("O")).alias("Tissue"),
        F.concat(F.lit("Trial "), code).alias("Panel"), F.concat(F.lit("NATION_"), code).alias("Experiment_ID"),
    )


PLOT_COLUMNS = ["name", "entityparent_id", "location_id", "general_identifier", "number", "entitytype_id"]


@query(
    "load_plots",
    f"""
with {SHEET_SQL}, {BASE_SQL}, fresh as (
  select coalesce(nullif(status, 'P'), '') as name, base.id as entityparent_id,
    case when place like '%Obregon%' then 2 when place like '%Birdcage%' then 5 end as location_id,
    id_text as general_identifier, id_text as number, 2 as entitytype_id
  from sheet left join base on base.general_identifier = accession where accession is not null)
{numbered_sql(PLOT_COLUMNS, "fresh", "(select max(id) from base)")}""",
)
def load_plots(spark, folder):
    return E.load_plots(order_sheet(spark, folder), {"germinatebase": base(spark, folder)}).new_rows


SAMPLE_COLUMNS = [
    "name", "general_identifier", "number", "entitytype_id", "biologicalstatus_id", "collsrc_id", "taxonomy_id", "created_on",
]


@query(
    "load_samples",
    f"""
with {SHEET_SQL}, {BASE_SQL}, fresh as (
  select coalesce(nullif(status, 'O'), priority) as name, id_text as general_identifier, id_text as number, 3 as entitytype_id,
    400 as biologicalstatus_id, 40 as collsrc_id, 1 as taxonomy_id, '{AS_OF}' as created_on
  from sheet where notes is distinct from 'Surplus Sample Number')
{numbered_sql(SAMPLE_COLUMNS, "fresh", "(select max(id) from base)")}""",
)
def load_samples(spark, folder):
    return E.load_samples(order_sheet(spark, folder), {"germinatebase": base(spark, folder)}, AS_OF).new_rows


TREE_SQL = f"""{SHEET_SQL}, tree as (select row + 1000000 as id, id_text as general_identifier from sheet)"""


def tree(spark, folder):
    return order_sheet(spark, folder).select(
        (F.col("row") + 1000000).alias("id"), F.col("Sample_ID").alias("general_identifier"),
        F.lit(None).cast("long").alias("entityparent_id"),
    )


@query(
    "sample_attributes",
    f"""
with {TREE_SQL}, live as (select * from sheet where notes is distinct from 'Surplus Sample Number'),
long as (
  select id_text, 12 as attribute_id, notes as value from live
  union all select id_text, 13, case substr(priority, 1, 1) when '2' then 'Frozen Leaf' when '3' then 'DNA Extraction' when '4' then 'Metabolomics' end from live
  union all select id_text, 14, nullif(priority, '1-URGENT') from live
  union all select id_text, 15, nullif(status, 'O') from live),
rows as (select attribute_id, tree.id as foreign_id, value from long join tree on tree.general_identifier = id_text where value is not null)
select *, '{AS_OF}' as created_on from rows where not (attribute_id = 15 and foreign_id <= 1000100)""",
)
def sample_attributes(spark, folder):
    """Class, notes, stage and tissue; the tissue of the first samples is stored already."""
    entity = tree(spark, folder)
    stored = entity.where("id <= 1000100").select(
        F.lit(15).alias("attribute_id"), F.col("id").alias("foreign_id"), F.explode(F.array(F.lit("F"), F.lit("P"))).alias("value")
    )
    tables = {"germinatebase": entity, "attributedata": stored}
    return E.sample_attributes(order_sheet(spark, folder), tables, AS_OF).new_rows


@query(
    "sample_parents",
    f"""
with {TREE_SQL}
select tree.id, tree.general_identifier, p.id as entityparent_id from tree join sheet on id_text = tree.general_identifier
left join tree p on p.general_identifier = case when notes is distinct from 'Surplus Sample Number' then coalesce(parent, accession) end""",
)
def sample_parents(spark, folder):
    sheet = order_sheet(spark, folder).withColumn("PlantPlot_ID", F.col("Plot_Of"))
    return E.sample_parents(sheet, tree(spark, folder))


GRAIN_COLUMNS = ["name", "entityparent_id", "general_identifier", "number", "entitytype_id"]


@query(
    "load_grain",
    f"""
with {SHEET_SQL}, {BASE_SQL}, fresh as (
  select priority as name, base.id as entityparent_id, concat('G', id_text) as general_identifier, concat('G', id_text) as number,
    10 as entitytype_id
  from (select *, coalesce(nullif(parent, 'O10'), accession) as pk from sheet) left join base on base.general_identifier = pk
  where pk is not null)
{numbered_sql(GRAIN_COLUMNS, "fresh", "(select max(id) from base)")}""",
)
def load_grain(spark, folder):
    sheet = order_sheet(spark, folder).withColumn("PlantPlot_ID", F.nullif("Parent_ID", F.lit("O10")))
    return E.load_grain(sheet, {"germinatebase": base(spark, folder)}).new_rows


TREE_COUNT_SQL = f"""
with {ACCESSION_SQL}, {BASE_SQL}, {SHEET_SQL}, live as (select * from sheet where notes is distinct from 'Surplus Sample Number')
select 'germinatebase' as target, count(*) as rows_added, 'accessions' as kind from accession
  where "Accession_ID" not in (select general_identifier from base)
union all select 'attributedata', {" + ".join(f'count("{name}")' for name in E.ACCESSION_ATTRIBUTES)}, 'accession_attributes' from accession
union all select 'germinatebase', count(accession), 'plots' from sheet
union all select 'germinatebase', count(*), 'samples' from live
union all select 'attributedata', count(notes) + count(case when substr(priority, 1, 1) in ('2', '3', '4') then 1 end)
  + count(nullif(priority, '1-URGENT')) + count(nullif(status, 'O')), 'sample_attributes' from live
union all select 'germinatebase', count(*), 'grain' from sheet"""


@query("load_entity_tree", TREE_COUNT_SQL)
def load_entity_tree(spark, folder):
    """All kinds in order, each seeing the entities added before; rows added per kind."""
    from plotloom.operators.reshape import union_all

    sheet = order_sheet(spark, folder)
    sheets = {
        "Accession": accessions(spark, folder), "Plant_Plot": sheet, "GrainPacket": sheet,
        "Sample": sheet.withColumn("Sample_ID", F.concat(F.lit("S"), "Sample_ID")),
    }
    tables = {
        "germinatebase": base(spark, folder).withColumn("name", F.lit("stored")),
        "attributedata": literal(spark, [], "attribute_id int, foreign_id long, value string, created_on string"),
    }
    results = E.load_tree(sheets, tables, AS_OF, {"accessions", "plots", "samples", "grain"})
    return union_all([r.report().withColumn("kind", F.lit(kind)) for kind, r in results.items()])


# Compounds of workbooks --------------------------------------------------------------------


def _register_names(kind: str, column: str) -> None:
    description, compound_class = E.COMPOUND_KINDS[kind]
    sql = f"""
with fresh as (
  select distinct {column} as name, '{description}' as description, '{compound_class}' as compound_class, '{AS_OF}' as created_on
  from part where {column} not in (select {column} from part where p_partkey <= 3))
{numbered_sql(["name", "description", "compound_class", "created_on"], "fresh", "(select max(p_partkey) from part where p_partkey <= 3)")}"""

    @query(f"load_{kind.replace(' ', '_')}_names", sql)
    def run(spark, folder):
        parts = table(spark, folder, "part")
        stored = parts.where("p_partkey <= 3").select(F.col("p_partkey").alias("id"), F.col(column).alias("name"))
        return E.load_compound_names(parts.select(F.col(column).alias("name")), kind, {"compounds": stored}, AS_OF).new_rows


for _kind, _column in (("peptide", "p_brand"), ("functional bin", "p_name"), ("metabolite", "p_type")):
    _register_names(_kind, _column)

LINES = [1, 2, 3, 4, 5, 6, 7]


@query(
    "load_bin_values",
    f"""
with long as (select l_partkey, l_linenumber, sum(l_quantity) as v from lineitem group by 1, 2)
select p_partkey as compound_id, l_linenumber as germinatebase_id, 1 as dataset_id, v as compound_value, '{AS_OF}' as created_on
from long join part on p_partkey = l_partkey and p_size > 5 where l_linenumber between 1 and 6 and v <> 10""",
)
def load_bin_values(spark, folder):
    """A matrix of parts by line number; empty and NaN cells and unknown samples give no row."""
    names = [f"IW_S{n}" for n in LINES]
    lines = table(spark, folder, "lineitem").select(
        F.concat(F.lit("Part "), F.col("l_partkey").cast("string")).alias("compound"),
        F.concat(F.lit("IW_S"), F.col("l_linenumber").cast("string")).alias("sample"), "l_quantity",
    )
    cell = F.when(F.sum("l_quantity") == 10, F.lit(float("nan"))).otherwise(F.sum("l_quantity"))
    sheet = to_wide(lines, ["compound"], "sample", names, cell)
    samples = literal(spark, [(n, f"IW_S{n}") for n in LINES[:6]], "id int, general_identifier string")
    tables = {**_compound_tables(spark, folder), "germinatebase": samples}
    return E.load_bin_values(sheet, tables, AS_OF).new_rows


# Older layout ------------------------------------------------------------------------------

OLD_COLUMNS = ["general_identifier", "number", "name", "biologicalstatus_id", "taxonomy_id", "created_on", "notes"]


def _old_accession_sql() -> str:
    from plotloom.queries.columns import NOTES_SQL

    return f"""
with {ACCESSION_SQL}, {BASE_SQL}, fresh as (
  select "Accession_ID" as general_identifier, "Accession_ID" as number, "Accession_name" as name, 400 as biologicalstatus_id,
    1 as taxonomy_id, '{AS_OF}' as created_on, {NOTES_SQL} as notes from accession)
{numbered_sql(OLD_COLUMNS, "fresh", "(select max(id) from base)")}"""


@query("old_accessions", _old_accession_sql())
def old_accessions(spark, folder):
    return E.old_accessions(accessions(spark, folder), {"germinatebase": base(spark, folder)}, AS_OF)


def _old_tables(spark, folder):
    nations = table(spark, folder, "nation")
    return {
        "germinatebase": base(spark, folder),
        "experiments": nations.selectExpr("n_nationkey as id", "n_name as experiment_number", "concat('X', n_name) as experiment_name"),
        "experimentdesign": nations.where("n_regionkey < 4").selectExpr("n_nationkey + 50 as id", "n_nationkey as experiments_id"),
        "trialseries": nations.selectExpr("n_nationkey as id", "concat('Trial ', cast(n_nationkey as string)) as seriesname"),
        "plantplot": table(spark, folder, "customer").selectExpr("c_custkey as id", "if(c_custkey = 0, 'Unknown', c_name) as number"),
        "tissue": literal(spark, [(1, "F"), (2, "Unknown")], "id int, name string"),
        "samplestage": literal(spark, [(1, "2-HIGH"), (2, "5-LOW"), (3, "Unknown")], "id int, name string"),
        "plantsample": literal(spark, [(0, "No Parent")], "id int, name string"),
    }


@query(
    "old_experiment_designs",
    f"""
with named as (select n_name as experiment_number, concat('Y', cast(n_regionkey as varchar)) as experiment_name from nation where n_regionkey <> 1),
rows as (select *, experiment_name as description, 3 as experiment_type_id, '{AS_OF}' as created_on from named),
added as ({numbered_sql(["experiment_number", "experiment_name", "description", "experiment_type_id", "created_on"], "rows", "(select max(n_nationkey) from nation)")}),
design as (select concat(rows.experiment_name, '_Design') as name, x.id as experiments_id, '{AS_OF}' as created_on
  from rows join (select experiment_name, min(id) as id from added group by 1) x on x.experiment_name = rows.experiment_name)
{numbered_sql(["name", "experiments_id", "created_on"], "design", "(select max(n_nationkey) + 50 from nation where n_regionkey < 4)")}""",
)
def old_experiment_designs(spark, folder):
    """A design row per sheet row, pointing at the first experiment of that name."""
    sheet = table(spark, folder, "nation").select(
        F.col("n_name").alias("Experiment_ID"),
        F.when(F.col("n_regionkey") != 1, F.concat(F.lit("Y"), F.col("n_regionkey").cast("string"))).alias("Experiment_Name"),
    )
    return E.old_experiments(sheet, _old_tables(spark, folder), AS_OF)[1]


OLD_PLOT_COLUMNS = ["number", "name", "germinatebase_id", "experimentdesign_id", "trialseries_id", "locations_id", "created_on"]


@query(
    "old_plots",
    f"""
with {SHEET_SQL}, {BASE_SQL}, fresh as (
  select id_text as number, coalesce(nullif(status, 'P'), '') as name, base.id as germinatebase_id, n.n_nationkey + 50 as experimentdesign_id,
    t.n_nationkey as trialseries_id, case when place like '%Obregon%' then 2 when place like '%Birdcage%' then 5 end as locations_id,
    '{AS_OF}' as created_on
  from sheet left join base on base.general_identifier = accession
  left join nation n on n.n_name = concat('NATION_', substr(priority, 1, 1)) and n.n_regionkey < 4
  left join nation t on cast(t.n_nationkey as varchar) = substr(priority, 1, 1)
  where accession is not null)
{numbered_sql(OLD_PLOT_COLUMNS, "fresh", "(select max(c_custkey) from customer)")}""",
)
def old_plots(spark, folder):
    return E.old_plots(order_sheet(spark, folder), _old_tables(spark, folder), AS_OF)


OLD_SAMPLE_COLUMNS = ["name", "plantplot_id", "altname", "tissue_id", "samplestage_id"]
OLD_SAMPLE_SQL = f"""{SHEET_SQL}, fresh as (
  select id_text as name, c_custkey as plantplot_id, coalesce(nullif(status, 'O'), '') as altname,
    case status when 'F' then 1 when 'O' then 2 end as tissue_id,
    case priority when '2-HIGH' then 1 when '5-LOW' then 2 when '1-URGENT' then 3 end as samplestage_id
  from sheet left join customer on coalesce(accession, 'Unknown') = case when c_custkey = 0 then 'Unknown' else c_name end)"""


def _old_sample_sheet(spark, folder):
    return order_sheet(spark, folder).withColumn("PlantPlot_ID", F.col("Plot_Of"))


@query("old_samples", f"with {OLD_SAMPLE_SQL} {numbered_sql(OLD_SAMPLE_COLUMNS, 'fresh', '0')}")
def old_samples(spark, folder):
    return E.old_samples(_old_sample_sheet(spark, folder), _old_tables(spark, folder))


@query(
    "old_sample_parents",
    f"""
with {SHEET_SQL}, samples as (select row + 1 as id, id_text as name from sheet union all select 0, 'No Parent')
select s.id, s.name, p.id as parentsample_id from samples s left join sheet on id_text = s.name
left join samples p on p.name = case when id_text is not null then coalesce(parent, 'No Parent') end""",
)
def old_sample_parents(spark, folder):
    sheet = order_sheet(spark, folder)
    samples = sheet.select((F.col("row") + 1).alias("id"), F.col("Sample_ID").alias("name"))
    root = literal(spark, [(0, "No Parent")], "id long, name string")
    stored = samples.unionByName(root).withColumn("parentsample_id", F.lit(None).cast("long"))
    return E.old_sample_parents(sheet, stored)


# Views -------------------------------------------------------------------------------------


def _with_passport(df):
    return df.withColumns({"colldate": F.lit("x"), "duplsite": F.lit("y")})


@query(
    "compound_view",
    f"""
with {DATASETS_SQL}, fact as (
  select l_partkey as compound_id, cast(l_suppkey as integer) as germinatebase_id, cast((year(l_shipdate) + 18) * 10 as integer) as dataset_id,
    l_extendedprice as compound_value from lineitem),
c as (select p_partkey as id, p_name as name, p_type as description from part where p_size > 10),
e as (select cast(s_suppkey as integer) as id, s_name as name, s_nationkey as location_id from supplier where s_acctbal > 0),
a as (select coalesce(fact.compound_id, c.id) as compound_id, germinatebase_id, dataset_id, compound_value, name, description
  from fact full join c on fact.compound_id = c.id),
b as (select compound_id, coalesce(a.germinatebase_id, e.id) as germinatebase_id, dataset_id, compound_value, a.name, description,
    e.name as name_entity, location_id from a full join e on a.germinatebase_id = e.id)
select compound_id, germinatebase_id, coalesce(b.dataset_id, d.id) as dataset_id, compound_value, name, b.description, name_entity, location_id,
  d.description as description_dataset, experiment_id, source_file from b full join datasets d on b.dataset_id = d.id""",
)
def compound_view(spark, folder):
    fact = table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("compound_id"), F.col("l_suppkey").cast("int").alias("germinatebase_id"),
        ((F.year("l_shipdate") + 18) * 10).alias("dataset_id"), F.col("l_extendedprice").alias("compound_value"),
    )
    compounds = table(spark, folder, "part").where("p_size > 10").selectExpr("p_partkey as id", "p_name as name", "p_type as description")
    entity = table(spark, folder, "supplier").where("s_acctbal > 0").selectExpr(
        "cast(s_suppkey as int) as id", "s_name as name", "s_nationkey as location_id"
    )
    tables = {
        "compounddata": fact, "compounds": compounds, "germinatebase": _with_passport(entity), "datasets": datasets(spark, folder),
    }
    return V.compound_view(tables)


EVENT_SQL = """series as (
  select event_id, event_type, user_id, cast(cast(ts as date) as date) as d, value from events)"""


def _trait_tables(spark, folder):
    """Events as dated traits: one phenotype per type and day, users as entities."""
    events = table(spark, folder, "events")
    dated = events.withColumn("day", F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")))
    trait = F.when(F.col("event_type") == "click", "NDVI").otherwise(F.col("event_type"))
    kinds = dated.select(
        (F.ascii("event_type") * 1000 + F.length("event_type") * 100 + F.col("day")).alias("id"),
        F.concat_ws(";", trait, F.date_format("ts", "dMMM")).alias("short_name"),
    ).distinct()
    data = dated.select(
        (F.ascii("event_type") * 1000 + F.length("event_type") * 100 + F.col("day")).alias("phenotype_id"),
        F.col("user_id").alias("germinatebase_id"), F.when(F.col("user_id") < 70, 1).otherwise(2).alias("dataset_id"),
        F.when(F.col("value") > 1, F.col("value").cast("string")).otherwise("NA").alias("phenotype_value"),
    )
    users = events.select(F.col("user_id").alias("id")).distinct().withColumn(
        "general_identifier", F.concat(F.lit("U"), F.col("id").cast("string"))
    )
    sets = literal(spark, 
        [(1, "GES24_Extras Lidar", "2024_GES_Extras_Lidar.csv", 5), (2, "GES24_Other Lidar", "2024_GES_Other_Lidar.csv", 6)],
        "id int, description string, source_file string, experiment_id int",
    )
    return {"phenotypedata": data, "phenotypes": kinds, "germinatebase": _with_passport(users), "datasets": sets}


@query(
    "trait_series",
    """
select user_id as germinatebase_id, concat('U', cast(user_id as varchar)) as general_identifier, cast(ts as date) as date,
  case when value > 1 then value end as value, 'NDVI' as trait,
  case when user_id < 70 then 'GES24_Extras Lidar' else 'GES24_Other Lidar' end as dataset
from events where event_type = 'click'""",
)
def trait_series(spark, folder):
    """Full joins, then the dated values of one trait."""
    series = V.trait_series(_trait_tables(spark, folder))
    return series.select("germinatebase_id", "general_identifier", "date", "value", "trait", "dataset")


@query(
    "growth_input",
    """
select case when value > 1 then value end as "Y", case when user_id < 70 then cast(date_diff('day', date '2023-12-01', cast(ts as date)) as double) end as "X",
  concat('U', cast(user_id as varchar)) as "ID", case when user_id < 70 then 'GES24_Extras' else 'GES24_Other' end as dataset,
  round(case when value > 1 then log10(value) end, 6) as "logY"
from events where event_type = 'click' and cast(ts as date) <> date '2024-01-16'""",
)
def growth_input(spark, folder):
    """Days since a sowing date only one data set has; one bad date is left out."""
    sowing = literal(spark, [("GES24_Extras", "2023-12-01")], "dataset string, date string")
    prepared = V.growth_input(V.trait_series(_trait_tables(spark, folder)), sowing, "2024-01-16")
    return prepared.withColumn("logY", rounded("logY"))


@query("parameter_table")
def parameter_table(spark, folder):
    """From the joined tables to one row of Gompertz parameters per plant."""
    from plotloom.growth.fit import fit

    sowing = literal(spark, [("GES24_Extras", "2023-12-01"), ("GES24_Other", "2023-12-01")], "dataset string, date string")
    prepared = V.growth_input(V.trait_series(_trait_tables(spark, folder)), sowing, None)
    return V.parameter_table(fit(prepared, ["ID"], "gompertz", "X", "Y"), prepared)


@query("growth_analysis_rates")
def growth_analysis_rates(spark, folder):
    """The whole analysis: joined tables, dated series, three models, Gompertz rate curves."""
    from plotloom.plans.analysis import growth_analysis

    sowing = literal(
        spark, [("GES24_Extras", "2023-12-01"), ("GES24_Other", "2023-12-01")], "dataset string, date string"
    )
    return growth_analysis(_trait_tables(spark, folder), sowing, excluded_date=None)["rates"]


@query(
    "panel_membership",
    """
with g as (select n_nationkey as id, n_name as name, 3 as grouptype_id from nation where n_regionkey = 1)
select g.id, g.name, g.grouptype_id, s_suppkey as foreign_id, case when s_acctbal > 0 then s_name end as general_id
from g left join supplier on s_nationkey = g.id""",
)
def panel_membership(spark, folder):
    nations = table(spark, folder, "nation")
    suppliers = table(spark, folder, "supplier")
    tables = {
        "groups": nations.select(
            F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"),
            F.when(F.col("n_regionkey") == 1, 3).otherwise(4).alias("grouptype_id"),
        ),
        "groupmembers": suppliers.selectExpr("s_nationkey as group_id", "s_suppkey as foreign_id"),
        "germinatebase": suppliers.selectExpr("s_suppkey as id", "if(s_acctbal > 0, s_name, null) as general_identifier"),
    }
    return V.panel_members(tables)


@query(
    "sample_vocabularies",
    f"""
with {SHEET_SQL}, w as (
  select 'Tissue' as list, nullif(status, 'O') as word, row from sheet union all select 'Stage', nullif(priority, '1-URGENT'), row from sheet
  union all select 'Sample_Type', case substr(priority, 1, 1) when '2' then 'Frozen Leaf' when '3' then 'DNA' end, row from sheet),
f as (select list, word, min(row) as first_pos from w where word is not null group by 1, 2)
select list, word, first_pos, cast(row_number() over (partition by list order by first_pos, word) - 1 as bigint) as index from f""",
)
def sample_vocabularies(spark, folder):
    from plotloom.operators.reshape import union_all

    lists = V.sample_vocabularies(order_sheet(spark, folder))
    return union_all(
        [words.select(F.lit(name).alias("list"), F.col(name).alias("word"), "first_pos", "index") for name, words in lists.items()]
    )
