"""Column functions and domain transforms."""

from __future__ import annotations

from pyspark.sql import functions as F

from plotloom.functions import domain as D
from plotloom.functions import scalar as S
from plotloom.literals import literal
from plotloom.queries.base import TRIAL_SQL, query, rounded, table, trial_sheet


@query(
    "file_name_parts",
    f"""
with {TRIAL_SQL}
select file, split_part(file, '_', 1) as year, split_part(file, '_', 2) as site, split_part(file, '_', 3) as trial,
  replace(split_part(file, '_', 4), '.csv', '') as datatype, cast(count(*) as bigint) as n
from trial group by 1""",
)
def file_name_parts(spark, folder):
    files = trial_sheet(spark, folder).groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    return D.file_name_parts(files)


@query(
    "normalise_site",
    f"""
with {TRIAL_SQL}
select distinct file, case when split_part(file, '_', 1) = '2017' then replace(split_part(file, '_', 2), 'GES', 'GES CR04')
  else replace(split_part(file, '_', 2), 'GES', 'GES VR11') end as site_name_short,
  case when split_part(file, '_', 2) = 'Obregon' then 4 else 1 end as institution_id
from trial""",
)
def normalise_site(spark, folder):
    files = D.file_name_parts(trial_sheet(spark, folder).select("file").distinct())
    sited = D.normalise_site(files).withColumn("institution_id", D.institution("site_name_short"))
    return sited.select("file", "site_name_short", "institution_id")


@query(
    "dataset_key",
    f"""
with {TRIAL_SQL}, d as (
  select distinct concat(split_part(file, '_', 2), split_part(file, '_', 1), '_', split_part(file, '_', 3)) as k, file from trial)
select file, case when k = 'Obregon2016_trial' then 'CIMMYT2016' when k like 'GES20%' then concat('GES', substr(k, 6)) else k end as description
from d""",
)
def dataset_key(spark, folder):
    files = D.file_name_parts(trial_sheet(spark, folder).select("file").distinct())
    return D.dataset_key(files).select("file", "description")


TRAIT_SQL = """headers as (
  select p_partkey, concat(p_type, case when p_size > 10 then concat('_', replace(p_brand, '#', '')) else '' end,
    case when p_size > 30 then concat('_', cast(p_size as varchar)) else '' end, case when p_size = 5 then '_' else '' end) as trait
  from part)"""


def _headers(spark, folder):
    parts = table(spark, folder, "part")
    brand = F.concat(F.lit("_"), F.replace("p_brand", F.lit("#"), F.lit("")))
    return parts.select(
        "p_partkey",
        F.concat(
            "p_type",
            F.when(F.col("p_size") > 10, brand).otherwise(""),
            F.when(F.col("p_size") > 30, F.concat(F.lit("_"), F.col("p_size").cast("string"))).otherwise(""),
            F.when(F.col("p_size") == 5, "_").otherwise(""),
        ).alias("trait"),
    )


@query(
    "trait_header",
    f"""
with {TRAIT_SQL}
select p_partkey, trait, nullif(split_part(trait, '_', 1), '') as short_name,
  nullif(split_part(trait, '_', 2), '') as unit_abbreviation, nullif(split_part(trait, '_', 3), '') as measure_id from headers""",
)
def trait_header(spark, folder):
    """Headers with one, two and three tokens and with a trailing separator."""
    return D.trait_header(_headers(spark, folder))


@query(
    "phenotype_name",
    f"""
with {TRAIT_SQL}, split as (
  select p_partkey, split_part(trait, '_', 1) as short_name, nullif(split_part(trait, '_', 2), '') as unit,
    nullif(split_part(trait, '_', 3), '') as m from headers),
typed as (select *, case when unit = 'Brand13' then 13 when unit is not null then 2 end as unit_id from split)
select p_partkey, case when m is null then lower(short_name) else concat(lower(short_name), ';', m) end as name,
  case when m is null then short_name else concat(short_name, ';', m) end as short_name, unit_id,
  case when unit_id = 13 then 'int' when unit_id is not null then 'float' else '' end as datatype from typed""",
)
def phenotype_name(spark, folder):
    split = D.trait_header(_headers(spark, folder)).withColumn("name", F.lower("short_name"))
    unit = F.when(F.col("unit_abbreviation") == "Brand13", 13).when(F.col("unit_abbreviation").isNotNull(), 2)
    typed = D.phenotype_datatype(D.phenotype_name(split).withColumn("unit_id", unit))
    return typed.select("p_partkey", "name", "short_name", "unit_id", "datatype")


@query(
    "replace_first",
    """
select doc_id, regexp_replace(text, 'the', '[THE]') as text, regexp_replace(source, 'e', 'E') as source from documents""",
)
def replace_first(spark, folder):
    """Whole texts, first occurrence only."""
    return table(spark, folder, "documents").select(
        "doc_id", S.replace_first("text", "the", "[THE]").alias("text"), S.replace_first("source", "e", "E").alias("source")
    )


@query(
    "clean_compound",
    """
with named as (
  select c_custkey, concat(c_name, case c_mktsegment when 'BUILDING' then ' Elke new' when 'MACHINERY' then ' new new' else '' end) as name,
    case when c_nationkey < 12 then 'Metabolomics-metabolite' else 'Proteomics-peptide' end as datatype from customer)
select c_custkey, regexp_replace(regexp_replace(name, ' Elke', ''), ' new', '') as name,
  split_part(datatype, '-', 2) as compound_class, split_part(datatype, '-', 1) as description from named""",
)
def clean_compound(spark, folder):
    segment = F.col("c_mktsegment")
    suffix = F.when(segment == "BUILDING", " Elke new").when(segment == "MACHINERY", " new new").otherwise("")
    named = table(spark, folder, "customer").select(
        "c_custkey", F.concat("c_name", suffix).alias("name"),
        F.when(F.col("c_nationkey") < 12, "Metabolomics-metabolite").otherwise("Proteomics-peptide").alias("datatype"),
    )
    return D.compound_class(D.clean_compound(named)).drop("datatype")


@query(
    "marker_interval",
    """
select p_partkey, coalesce(nullif(p_type, 'PROMO'), 'Unmapped') as chromosome, p_size as definition_start,
  p_size + nullif(p_partkey, 7) as definition_end from part""",
)
def marker_interval(spark, folder):
    parts = table(spark, folder, "part").select(
        "p_partkey", F.nullif("p_type", F.lit("PROMO")).alias("chrom"), F.col("p_size").alias("pos"),
        F.nullif("p_partkey", F.lit(7)).alias("shift"),
    )
    return D.marker_interval(parts, "chrom", "pos", "shift").drop("chrom", "pos", "shift")


@query(
    "location_rule",
    """
with sites as (
  select o_orderkey, concat('plot at ', case substr(o_orderpriority, 1, 1) when '1' then 'Acacia Obregon' when '2' then 'GES17 block'
    when '3' then 'Naracoorte, SA' when '4' then 'GES 2018' else o_orderpriority end) as site from orders)
select o_orderkey, case when site like '%Acacia%' then 4 when site like '%Obregon%' then 2 when site like '%GES17%' then 1
  when site like '%Naracoorte, SA%' then 7 when site like '%GES 2018%' then 6 end as location_id,
  case when site like '%Obregon%' then 2 when site like '%GES17%' then 1 end as first_location_id from sites""",
)
def location_rule(spark, folder):
    """Ordered substring rules of both layouts; a site without a hit gets null."""
    code = F.substring("o_orderpriority", 1, 1)
    name = (
        F.when(code == "1", "Acacia Obregon").when(code == "2", "GES17 block").when(code == "3", "Naracoorte, SA")
        .when(code == "4", "GES 2018").otherwise(F.col("o_orderpriority"))
    )
    sites = table(spark, folder, "orders").select("o_orderkey", F.concat(F.lit("plot at "), name).alias("site"))
    return sites.select(
        "o_orderkey",
        D.location_rule("site").alias("location_id"),
        D.location_rule("site", D.LOCATION_RULES_FIRST).alias("first_location_id"),
    )


@query(
    "sample_class",
    """
with s as (
  select o_orderkey, case substr(o_orderpriority, 1, 1) when '1' then 'Frozen Leaf 2' when '2' then 'DNA' when '3' then 'dried' end as t,
    case o_orderstatus when 'F' then 'Backup' when 'P' then 'Original Leaf tissue' when 'O' then
      case when o_custkey > 700 then 'Q2 assay' when o_custkey > 500 then 'Metabolomics' when o_custkey > 300 then 'Proteomics'
        when o_custkey > 100 then 'Genotyping' end end as p from orders),
l as (select o_orderkey, lower(coalesce(t, '')) as t, lower(coalesce(p, '')) as p from s)
select o_orderkey, case when p = 'backup' then 'Backup' when p like '%q2%' then 'Q2'
  when t like '%frozen leaf%' and p in ('', 'prot/met', 'tissue sample') then 'Frozen Leaf'
  when p in ('genotyping', 'dna') or t = 'dna' then 'DNA Extraction' when p = 'metabolomics' then 'Metabolomics'
  when p = 'proteomics' then 'Proteomics' when p like '%original leaf%' then 'Original Leaf' end as class from l""",
)
def sample_class(spark, folder):
    code, status, buyer = F.substring("o_orderpriority", 1, 1), F.col("o_orderstatus"), F.col("o_custkey")
    aim = (
        F.when(status == "F", "Backup").when(status == "P", "Original Leaf tissue")
        .when((status == "O") & (buyer > 700), "Q2 assay").when((status == "O") & (buyer > 500), "Metabolomics")
        .when((status == "O") & (buyer > 300), "Proteomics").when((status == "O") & (buyer > 100), "Genotyping")
    )
    kind = F.when(code == "1", "Frozen Leaf 2").when(code == "2", "DNA").when(code == "3", "dried")
    samples = table(spark, folder, "orders").select("o_orderkey", kind.alias("Sample_Type"), aim.alias("Purpose"))
    return samples.select("o_orderkey", D.sample_class("Sample_Type", "Purpose").alias("class"))


ACCESSION_SQL = """accession as (
  select c_name as "Accession_ID", c_mktsegment as "Accession_name", c_custkey as row,
    case when c_nationkey > 0 then concat('Customer#', lpad(cast(c_nationkey as varchar), 9, '0')) end as "Parent_ID",
    nullif(c_mktsegment, 'BUILDING') as "Cross", case when c_acctbal > 0 then concat('ped ', c_mktsegment) end as "Pedigree",
    concat('N', cast(c_nationkey as varchar)) as "Source", case when c_nationkey > 12 then cast(c_nationkey as varchar) end as "Cid",
    case when c_nationkey > 18 then 'S1' end as "Sid", cast(null as varchar) as "GID",
    case when c_acctbal > 9000 then 'rich' end as "Other_ID", cast(null as varchar) as "Alternative_Name_1",
    cast(null as varchar) as "Alternative_Name_2", case when c_acctbal < -900 then 'third' end as "Alternative_Name_3",
    cast(null as varchar) as "Alternative_ID", case when c_acctbal < 0 then 'in debt' end as "Notes" from customer)"""


def accessions(spark, folder):
    nation, balance = F.col("c_nationkey"), F.col("c_acctbal")
    empty = F.lit(None).cast("string")
    return table(spark, folder, "customer").select(
        F.col("c_name").alias("Accession_ID"), F.col("c_mktsegment").alias("Accession_name"), F.col("c_custkey").alias("row"),
        F.when(nation > 0, F.concat(F.lit("Customer#"), F.lpad(nation.cast("string"), 9, "0"))).alias("Parent_ID"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("Cross"),
        F.when(balance > 0, F.concat(F.lit("ped "), F.col("c_mktsegment"))).alias("Pedigree"),
        F.concat(F.lit("N"), nation.cast("string")).alias("Source"),
        F.when(nation > 12, nation.cast("string")).alias("Cid"), F.when(nation > 18, "S1").alias("Sid"), empty.alias("GID"),
        F.when(balance > 9000, "rich").alias("Other_ID"), empty.alias("Alternative_Name_1"), empty.alias("Alternative_Name_2"),
        F.when(balance < -900, "third").alias("Alternative_Name_3"), empty.alias("Alternative_ID"),
        F.when(balance < 0, "in debt").alias("Notes"),
    )


NOTES_SQL = " || ".join(
    f"coalesce('{label}: ' || \"{column}\" || ', ', '')" for label, column in D.NOTE_PARTS
)


@query("accession_notes", f'with {ACCESSION_SQL} select "Accession_ID", {NOTES_SQL} as notes from accession')
def accession_notes(spark, folder):
    return D.accession_notes(accessions(spark, folder)).select("Accession_ID", "notes")


@query(
    "sample_name",
    """
with s as (select o_orderkey, nullif(o_orderstatus, 'O') as sample_name, o_orderpriority as plant_name,
  case when o_orderstatus = 'P' then 'Surplus Sample Number' when o_orderstatus = 'F' then 'kept' end as notes from orders)
select o_orderkey, coalesce(sample_name, plant_name) as name from s where notes is distinct from 'Surplus Sample Number'""",
)
def sample_name(spark, folder):
    """Rows tagged as surplus are left out, rows without notes stay."""
    status = F.col("o_orderstatus")
    samples = table(spark, folder, "orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("O")).alias("Sample_Name"), F.col("o_orderpriority").alias("Plant_Name"),
        F.when(status == "P", D.SURPLUS_NOTE).when(status == "F", "kept").alias("Notes"),
    )
    return D.sample_name(samples.where(D.not_surplus())).select("o_orderkey", "name")


@query(
    "experiment_code",
    """
select s_suppkey, case when s_suppkey > 10 then concat('IW_E00', cast(s_suppkey as varchar))
  else concat('IW_E000', cast(s_suppkey as varchar)) end as code, concat(s_name, ' GBS') as group_name from supplier""",
)
def experiment_code(spark, folder):
    return table(spark, folder, "supplier").select(
        "s_suppkey", D.experiment_code("s_suppkey").alias("code"), D.genotype_group("s_name").alias("group_name")
    )


@query(
    "measure_date",
    """
with m as (
  select event_id, case when event_type = 'error' then 'soon' else strftime(ts, '%-d%b') end as dm,
    case when event_type = 'click' then 'GES18_Extras' when event_type = 'view' then 'GES18_ExKsub' else 'other' end as ds from events),
d as (select event_id, ds, cast(try_strptime(concat(dm, '2024'), '%d%b%Y') as date) as date from m)
select event_id, date, cast(date_diff('day', case when ds <> 'other' then date '2023-12-08' end, date) as integer) as days from d""",
)
def measure_date(spark, folder):
    """Day and month from the trait, year from the file, days since a sowing date that some lack."""
    from plotloom.operators.keys import lookup

    kind = F.col("event_type")
    day = F.when(kind == "error", "soon").otherwise(F.date_format("ts", "dMMM"))
    rows = table(spark, folder, "events").select(
        "event_id", F.concat(F.lit("NDVI;"), day).alias("short_name"), F.lit("2024_GES_x_Lidar.csv").alias("source_file"),
        F.when(kind == "click", "GES18_Extras").when(kind == "view", "GES18_ExKsub").otherwise("other").alias("dataset"),
    )
    sowing = literal(spark, 
        [("GES18_Extras", "2023-12-08"), ("GES18_ExKsub", "2023-12-08")], "dataset string, date string"
    )
    dated = lookup(D.measure_date(rows), sowing, "dataset", "dataset", {"sowing": "date"}, ["date"])
    return D.days_since(dated, "date", F.to_date("sowing")).select("event_id", "date", "days")


@query(
    "to_number",
    """
with t as (select event_id, case event_type when 'click' then cast(value as varchar) when 'view' then 'NA' when 'error' then 'NaN'
  when 'purchase' then concat(cast(value as varchar), 'e1') else '' end as text from events)
select event_id, case when not isnan(try_cast(text as double)) then round(try_cast(text as double), 6) end as number,
  case when trim(text) not in ('', 'NA', 'NaN') then text end is null as missing from t""",
)
def to_number(spark, folder):
    kind, text = F.col("event_type"), F.col("value").cast("string")
    cells = table(spark, folder, "events").select(
        "event_id",
        F.when(kind == "click", text).when(kind == "view", "NA").when(kind == "error", "NaN")
        .when(kind == "purchase", F.concat(text, F.lit("e1"))).otherwise("").alias("text"),
    )
    return cells.select(
        "event_id", rounded(S.to_number("text")).alias("number"), S.missing_to_null("text").isNull().alias("missing")
    )


@query(
    "safe_math",
    """
select l_orderkey, l_linenumber, l_partkey,
  round(case when l_discount <> 0 then l_tax / l_discount end, 6) as ratio,
  round(case when l_discount > 0 then ln(l_discount) end, 6) as log_discount,
  round(case when l_tax > 0 then log10(l_tax) end, 6) as log10_tax,
  round(exp(l_discount), 6) as exp_discount, round(pow(l_quantity, l_discount), 6) as power, round(sqrt(l_quantity), 6) as root
from lineitem""",
)
def safe_math(spark, folder):
    """Division and logarithms give null where they are undefined."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        rounded(S.divide("l_tax", "l_discount")).alias("ratio"),
        rounded(F.ln("l_discount")).alias("log_discount"), rounded(F.log10("l_tax")).alias("log10_tax"),
        rounded(F.exp("l_discount")).alias("exp_discount"), rounded(F.pow("l_quantity", "l_discount")).alias("power"),
        rounded(F.sqrt("l_quantity")).alias("root"),
    )


@query(
    "if_else",
    """
select l_orderkey, l_linenumber, l_partkey, case when f is null then null when f = 'A' then 'yes' else 'no' end as choice,
  coalesce(f, '') as filled, f || '/' || l_linestatus as pair, lower(l_linestatus) as low
from (select *, nullif(l_returnflag, 'N') as f from lineitem)""",
)
def if_else(spark, folder):
    """An unknown condition gives an unknown result; joining text with null gives null."""
    flag = F.nullif("l_returnflag", F.lit("N"))
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        S.if_else(flag == "A", F.lit("yes"), F.lit("no")).alias("choice"), F.coalesce(flag, F.lit("")).alias("filled"),
        S.glue(flag, "l_linestatus", separator="/").alias("pair"), F.lower("l_linestatus").alias("low"),
    )


@query(
    "even_steps",
    """
select s_suppkey, cast(i as integer) as step, round(s_acctbal + i * (10000 - s_acctbal) / 9.0, 6) as value
from supplier, range(10) r(i)""",
)
def even_steps(spark, folder):
    steps = S.even_steps("s_acctbal", F.lit(10000.0), 10)
    return table(spark, folder, "supplier").select("s_suppkey", F.posexplode(steps).alias("step", "value")).withColumn(
        "value", rounded("value")
    )


@query(
    "standard_normal",
    """
with u as (
  select s_suppkey, (('0x' || substr(md5(concat('7|', cast(s_suppkey as varchar), '|u')), 1, 12))::bigint + 0.5::double) / 281474976710656.0::double as u,
    (('0x' || substr(md5(concat('7|', cast(s_suppkey as varchar), '|v')), 1, 12))::bigint + 0.5::double) / 281474976710656.0::double as v from supplier)
select s_suppkey, round(sqrt(-2 * ln(u)) * cos(2 * pi() * v), 6) as z from u""",
)
def standard_normal(spark, folder):
    """Repeatable normal numbers from the md5 of seed and key."""
    return table(spark, folder, "supplier").select("s_suppkey", rounded(S.standard_normal(F.lit("7"), "s_suppkey")).alias("z"))


@query(
    "attribute_map",
    "select attribute, attribute_id, cast(count(c_custkey) as bigint) as n from (values "
    + ", ".join(f"('{k}', {v})" for k, v in D.ATTRIBUTE_IDS.items())
    + ") a(attribute, attribute_id) left join customer on c_nationkey = attribute_id group by 1, 2",
)
def attribute_map(spark, folder):
    """The fixed attribute ids, with how many customers carry each as nation."""
    joined = D.attribute_map(spark).join(
        table(spark, folder, "customer"), F.col("c_nationkey") == F.col("attribute_id"), "left"
    )
    return joined.groupBy("attribute", "attribute_id").agg(F.count("c_custkey").alias("n"))
