"""The sheet reader over lines that driver tables are written out as, in several header layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotloom.queries.base import FILE_SQL, file_name, query, table
from plotloom.sources import sheets

# Lines of a block in the order they would be written; the header is above all others.
LINES = ["path", "file", "block", "line", "value"]


def _header_lines(rows: DataFrame, top) -> DataFrame:
    """One line per file for each of the texts ahead of its rows."""
    paths = rows.select("path", "file", "layout").distinct()
    lines = paths.select("path", "file", F.lit(0).cast("long").alias("block"), F.posexplode(top).alias("line", "value"))
    return lines.withColumn("line", (F.col("line") - 100).cast("long")).select(*LINES)


def trial_lines(spark, folder) -> DataFrame:
    """Line items as trial sheets in two folders whose files have the same names.

    Layout 0 is plain.  Layout 1 has a blank first line, another column order and blanks around cells.
    Layout 2 is quoted, with a line break inside a header and inside every Panel.
    """
    layout = F.col("l_orderkey") % 3
    rows = table(spark, folder, "lineitem").select(
        layout.cast("int").alias("layout"),
        file_name().alias("file"),
        F.concat(F.lit("sheets/"), layout.cast("string"), F.lit("/"), file_name()).alias("path"),
        F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")).alias("ID"),
        F.concat(F.lit("Panel "), F.col("l_linenumber").cast("string")).alias("Panel"),
        F.when(F.col("l_tax") == 0, "NA").otherwise(F.round(F.col("l_tax") * 100).cast("long").cast("string")).alias("tax"),
        F.col("l_quantity").cast("long").cast("string").alias("quantity"),
        # Every row has room for two lines; a block ends inside a row now and then.
        (F.monotonically_increasing_id() * 2).alias("at"),
    )
    plain = F.concat_ws(",", "ID", "Panel", "quantity", "tax")
    turned = F.concat_ws(" , ", "tax", "ID", "quantity")
    first = F.concat(F.lit('"'), "ID", F.lit('","'), F.col("Panel"))
    second = F.concat(F.lit('say ""x"""'), F.lit(","), "quantity")
    text = F.when(F.col("layout") == 0, F.array(plain)).when(F.col("layout") == 1, F.array(turned, F.lit("")))
    body = rows.select("path", "file", "at", F.posexplode(text.otherwise(F.array(first, second))).alias("i", "value"))
    line = F.col("at") + F.col("i")
    body = body.select("path", "file", (line / 4095).cast("long").alias("block"), line.alias("line"), "value")
    top = (
        F.when(F.col("layout") == 0, F.array(F.lit("ID,Panel,quantity_kg_1,tax_pct")))
        .when(F.col("layout") == 1, F.array(F.lit(""), F.lit(" tax_pct ,ID,quantity_kg_1")))
        .otherwise(F.array(F.lit('ID,"Panel'), F.lit('of plot",quantity_kg_1')))
    )
    return body.unionByName(_header_lines(rows, top))


TRIAL_LINES_SQL = f"""items as (
  select l_orderkey % 3 as layout, {FILE_SQL} as file, concat('Supplier#', lpad(cast(l_suppkey as varchar), 9, '0')) as "ID",
    concat('Panel ', cast(l_linenumber as varchar)) as panel, cast(cast(l_quantity as bigint) as varchar) as quantity,
    case when l_tax <> 0 then cast(cast(round(l_tax * 100) as bigint) as varchar) end as tax
  from lineitem),
cells as (
  select layout, file, "ID", 'Panel' as name, panel as value from items where layout = 0
  union all select layout, file, "ID", concat('Panel', chr(10), 'of plot'), concat(panel, chr(10), 'say "x"')
    from items where layout = 2
  union all select layout, file, "ID", 'quantity_kg_1', quantity from items
  union all select layout, file, "ID", 'tax_pct', tax from items where layout < 2 and tax is not null)"""


@query("sheet_cells", f"with {TRIAL_LINES_SQL} select file, \"ID\", name, value from cells")
def sheet_cells(spark, folder):
    return sheets.read_long(trial_lines(spark, folder), ["ID"]).select("file", "ID", "name", "value")


@query(
    "sheet_headers",
    """select distinct concat('sheets/', cast(l_orderkey % 3 as varchar), '/', """
    + FILE_SQL
    + """) as path, case l_orderkey % 3 when 0 then 'ID|Panel|quantity_kg_1|tax_pct' when 1 then 'tax_pct|ID|quantity_kg_1'
      else concat('ID|Panel', chr(10), 'of plot|quantity_kg_1') end as header from lineitem""",
)
def sheet_headers(spark, folder):
    found = sheets.headers(trial_lines(spark, folder))
    return found.select("path", F.array_join("header", "|").alias("header"))


def part_lines(spark, folder) -> DataFrame:
    """Parts as sheets with two lines of preamble, one of which opens a quote; some rows are ragged."""
    parts = table(spark, folder, "part")
    layout = (F.substring("p_brand", -1, 1).cast("int") % 2).alias("layout")
    rows = parts.select(
        "p_partkey",
        layout,
        F.concat(F.lit("parts/"), "p_brand", F.lit(".csv")).alias("path"),
        F.concat("p_brand", F.lit(".csv")).alias("file"),
        F.concat(F.lit('"'), "p_name", F.lit('"')).alias("name"),
        "p_brand",
        F.when(F.col("p_size") % 5 == 0, "NaN").otherwise(F.col("p_size").cast("string")).alias("size"),
        F.when(F.col("p_size") % 7 == 0, F.lit(",x, ,y")).otherwise(F.lit("")).alias("surplus"),
    )
    key = F.col("p_partkey").cast("string")
    text = F.when(F.col("layout") == 0, F.concat_ws(",", key, "name", "size")).otherwise(
        F.when(F.col("p_partkey") % 4 == 0, F.concat_ws(",", "p_brand", "size")).otherwise(
            F.concat_ws(",", "p_brand", "size", key, "name")
        )
    )
    ragged = F.when((F.col("layout") == 0) | (F.col("p_partkey") % 4 != 0), F.col("surplus")).otherwise(F.lit(""))
    body = rows.select(
        "path",
        "file",
        (F.col("p_partkey") / 64).cast("long").alias("block"),
        F.col("p_partkey").cast("long").alias("line"),
        F.concat(text, ragged).alias("value"),
    )
    names = F.when(F.col("layout") == 0, F.lit("key,name,size")).otherwise(F.lit('brand,size,"key",name'))
    top = F.array(F.lit('made by "someone'), F.lit("key,size"), F.lit(""), names)
    return body.unionByName(_header_lines(rows, top))


PARTS_SQL = """parts as (
  select *, cast(substr(p_brand, -1, 1) as integer) % 2 as layout, concat(p_brand, '.csv') as file,
    case when p_size % 5 <> 0 then cast(p_size as varchar) end as size,
    cast(substr(p_brand, -1, 1) as integer) % 2 = 1 and p_partkey % 4 = 0 as short
  from part)"""


@query(
    "sheet_columns",
    f"""with {PARTS_SQL}
select file, case when not short then cast(p_partkey as varchar) end as "key", case when not short then p_name end as name,
  size, case when layout = 1 then p_brand end as brand, cast(null as varchar) as other from parts""",
)
def sheet_columns(spark, folder):
    return sheets.read_columns(part_lines(spark, folder), ["key", "name", "size", "brand", "other"], skip=2).drop("order")


@query(
    "sheet_rejects",
    f"""with {PARTS_SQL} select concat('parts/', file) as path, cast(p_partkey // 64 as bigint) as block_start,
  'surplus cells' as problem, 'x|y' as surplus from parts where p_size % 7 = 0 and not short""",
)
def sheet_rejects(spark, folder):
    found = sheets.rejects(sheets.read_rows(part_lines(spark, folder), skip=2))
    return found.select("path", "block_start", "problem", F.array_join("surplus", "|").alias("surplus"))
