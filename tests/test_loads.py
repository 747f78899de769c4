"""Loads from files: two sites, several data types, different headers."""

import pytest
from pyspark.sql import functions as F

from plotloom.functions.domain import COMPOUND_TYPES, GENOTYPE_TYPES, TRIAL_TYPES
from plotloom.operators.sizing import cut_lineage
from plotloom.plans import entities as E
from plotloom.plans import trials as T
from plotloom.plans.vocabularies import VOCABULARIES, load_vocabulary
from plotloom.sources import sheets as S
from plotloom.sources import tables as TB

FILES = {
    "2016_Obregon_trial_Harvest.csv": "ID,Panel,yield_kg_1,height_cm\nIW_P1,A,3.5,90\nIW_P2,A,NA,91\n",
    "2017_GES_Ex sub_Harvest.csv": 'ID, height_cm,Panel,unknown_x\n"IW,P3", 70 ,B,"1 ""a"""\nIW_P1,71,B,NaN\n',
    "2018_GES_Extras_Lidar.csv": "ID,Panel,NDVI_index_5Sep\nName4,C,0.5\nIW_P1,C,0.6\n",
    "2018_GES_trial_Proteomics-peptide.csv": "compound,experiment_name,IW_S1,IW_S2\npep Elke,GES2018_trial,1.5,NA\npep2 new,GES2018_trial,2.5,3.5\n",
    "2018_GES_trial_Metabolomics-metabolite.csv": "compound,experiment_name,IW_S2\nmet,GES2018_trial,9\n",
    "2016_Obregon_CAIGE_GBS.csv": "*a\n*b,x\n*\n*\n*a\nAlleleID,Chrom_Wheat_ChineseSpring04,ChromPos_Wheat_ChineseSpring04,SNP,SnpPosition\n\nm1,1A,100,A>G,5\nm2,NA,200,A>C,NA\n*a,2B,1,T>A,1\n",
    "Phenotypes_README.csv": "short_name,name,Description\nyield,Yield,kg of grain\nheight,Height,cm\nNDVI,Index,greenness\n",
    "notes.txt": "ignored",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("trial data")
    for name, text in FILES.items():
        (path / name).write_text(text)
    return str(path)


@pytest.fixture(scope="module")
def files(spark, folder):
    return S.discover(spark, folder)


@pytest.fixture(scope="module")
def lines(spark, folder):
    return S.scan(spark, folder)


@pytest.fixture(scope="module")
def tables(spark):
    make = spark.createDataFrame
    return {
        "germinatebase": make(
            [(1, "IW_P1", "IW_P1", "n1", 1), (2, "IW,P3", None, "n3", 2), (4, None, "x", "Name4", 3), (5, "IW_S1", None, "s", 3), (6, "IW_S2", None, "s", 3)],
            "id int, general_identifier string, number string, name string, entitytype_id int",
        ),
        "locations": make([(1, "GES CR04"), (2, "GES VR11"), (3, "Obregon")], "id int, site_name_short string"),
        "groups": make([(1, "A", "x")], "id int, name string, description string"),
        "groupmembers": make([], "foreign_id int, group_id int"),
        "markers": make([(1, "m2")], "id int, marker_name string"),
        "mapdefinitions": make([], "marker_id int"),
        "experiments": make([(22, "GES18_trial Metabolomics-metabolite")], "id int, description string"),
        "datasets": make([(9, "CIMMYT2016 Harvest")], "id int, description string"),
        "compounds": make([(1, "pep")], "id int, name string"),
        "compounddata": make([], "compound_id int, germinatebase_id int, dataset_id int"),
        "units": make([(13, "index")], "id int, unit_abbreviation string"),
        "phenotypes": make([(1, "Height", "height")], "id int, name string, short_name string"),
        "phenotypedata": make([], "phenotype_id int, germinatebase_id int, dataset_id int"),
    }


def of_type(files, types):
    return files.where(F.col("datatype").isin(types))


def rows(frame, *columns):
    return {tuple(r) for r in (frame.select(*columns) if columns else frame).collect()}


def after(table, result):
    return cut_lineage(table.unionByName(result.new_rows, allowMissingColumns=True))


def test_discovery_and_reading(spark, folder, lines):
    assert S.discover(spark, folder).count() == 7
    plots = S.read_columns(of_type(lines, TRIAL_TYPES), ["ID", "Panel"])
    assert rows(plots, "ID", "Panel") == {("IW_P1", "A"), ("IW_P2", "A"), ("IW,P3", "B"), ("IW_P1", "B"), ("Name4", "C"), ("IW_P1", "C")}
    cells = S.read_long(of_type(lines, TRIAL_TYPES), ["ID"])
    assert ("IW_P1", "height_cm", "71") in rows(cells, "ID", "name", "value")
    assert cells.where("name = 'yield_kg_1'").count() == 1 and cells.where("value = 'NaN'").count() == 0
    geno = S.read_columns(of_type(lines, GENOTYPE_TYPES), ["AlleleID", "SnpPosition"], skip=5)
    assert rows(geno, "AlleleID", "SnpPosition") == {("m1", "5"), ("m2", None), ("*a", "1")}
    key = S.read_sheet(spark, f"{folder}/Phenotypes_README.csv")
    assert key.columns == ["short_name", "name", "Description"] and key.count() == 3
    with pytest.raises(ValueError):
        S.read_sheet(spark, f"{folder}/*_Harvest.csv")


def test_plain_read_would_mix_columns(spark, folder, lines):
    """Why the headers are read first: by position, one file's height lands under another's panel."""
    cells = S.read_long(of_type(lines, ["Harvest"]), ["ID"])
    assert rows(cells.where("ID = 'IW,P3'"), "name", "value") == {("height_cm", "70"), ("Panel", "B"), ("unknown_x", '1 "a"')}


def test_large_file_drops_its_preamble_once(spark, tmp_path):
    lines = [f"m{i % 7},{i}" for i in range(200_000)]
    (tmp_path / "2016_x_y_GBS.csv").write_text("p\nm1,1\nAlleleID,pos\n" + "\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 200_000)
    try:
        read = S.read_columns(S.scan(spark, str(tmp_path)), ["AlleleID", "pos"], skip=2)
        assert read.count() == 200_000
        assert read.agg(F.sum(F.col("pos").cast("long"))).first()[0] == sum(range(200_000))
        placed = read.select("pos", F.row_number().over(__import__("pyspark").sql.Window.orderBy("order")).alias("n"))
        assert placed.where("n <> cast(pos as int) + 1").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_marker_loads(lines, tables):
    geno = S.read_columns(
        of_type(lines, GENOTYPE_TYPES), ["AlleleID", T.CHROMOSOME, T.POSITION, "SNP", T.OFFSET], skip=5
    ).withColumns({c: F.col(c).try_cast("int") for c in (T.POSITION, T.OFFSET)})
    first = T.load_markers(geno, tables)
    assert rows(first.new_rows, "marker_name") == {("m1",), ("*a",)} and {r["id"] for r in first.new_rows.collect()} == {2, 3}
    known = {**tables, "markers": after(tables["markers"], first)}
    assert T.load_markers(geno, known).new_rows.count() == 0
    maps = T.load_map_definitions(geno, known).new_rows
    assert rows(maps, "definition_start", "definition_end", "chromosome") == {(100, 105, "1A"), (200, None, "Unmapped"), (1, 2, "2B")}
    groups = T.load_genotype_groups(geno, known)
    assert rows(groups.new_rows, "name", "grouptype_id") == {("CAIGE GBS", 2)}
    known["groups"] = after(tables["groups"], groups)
    assert T.load_marker_members(geno, known).new_rows.count() == 3


def test_group_loads(lines, tables):
    plots = S.later_first(S.read_columns(of_type(lines, TRIAL_TYPES), ["ID", "Panel"]))
    panels = T.load_panel_groups(plots, tables)
    assert rows(panels.new_rows, "id", "name") <= {(2, "B"), (3, "B"), (2, "C"), (3, "C")} and panels.new_rows.count() == 2
    known = {**tables, "groups": after(tables["groups"], panels)}
    sites = T.load_site_groups(plots, known)
    assert rows(sites.new_rows, "name") == {("GES CR04",), ("GES VR11",), ("Obregon",)}
    known["groups"] = after(known["groups"], sites)
    members = T.load_panel_members(plots, known)
    assert members.new_rows.count() == 5 and members.rejects.count() == 1
    known["groupmembers"] = members.new_rows
    assert T.load_panel_members(plots, known).new_rows.count() == 0
    assert T.load_site_members(plots, known).new_rows.count() == 3
    assert T.load_site_members(plots, known, ["foreign_id"]).new_rows.count() == 1


def test_entity_refresh_prefers_the_last_file(lines, tables):
    plots = S.later_first(S.read_columns(of_type(lines, TRIAL_TYPES), ["ID", "Panel"]))
    found = T.refresh_entities(plots, tables)
    assert {r["id"]: (r["location_id"], r["institution_id"]) for r in found.collect()} == {
        1: (2, 1), 2: (1, 1), 4: (2, 1), 5: (None, None), 6: (None, None),
    }


def test_experiments_and_datasets(files, lines, tables):
    compounds = S.read_long(of_type(lines, COMPOUND_TYPES), ["compound", "experiment_name"], drop_nulls=False)
    made = T.load_compound_experiments(S.later_first(compounds), tables)
    assert rows(made.new_rows, "experiment_name", "description", "experiment_type_id") == {
        ("IW_E0023", "GES18_trial Proteomics-peptide", 6)
    }
    known = {**tables, "experiments": after(tables["experiments"], made)}
    sets = T.load_datasets(of_type(files, TRIAL_TYPES + GENOTYPE_TYPES + COMPOUND_TYPES), known, "somebody")
    found = {r["description"]: r for r in sets.new_rows.collect()}
    assert set(found) == {
        "GES17_Ex sub Harvest", "GES18_Extras Lidar", "GES18_trial Proteomics-peptide",
        "GES18_trial Metabolomics-metabolite", "Obregon2016_CAIGE GBS",
    }
    assert found["GES18_trial Metabolomics-metabolite"]["experiment_id"] == 22
    assert found["GES17_Ex sub Harvest"]["location_id"] == 1
    known["datasets"] = after(tables["datasets"], sets)
    assert T.load_datasets(files.where("datatype is not null"), known, "somebody").new_rows.where("datatype = 'Lidar'").count() == 0
    empty = {"datasets": known["datasets"], "datasetmembers": sets.new_rows.selectExpr("id as dataset_id").limit(2)}
    assert T.load_dataset_members(empty).new_rows.count() == 4


def test_compound_loads(files, lines, tables):
    cells = S.read_long(of_type(lines, COMPOUND_TYPES), ["compound", "experiment_name"])
    sheet = S.read_columns(of_type(lines, COMPOUND_TYPES), ["compound"])
    made = T.load_compounds(sheet.select("file", "compound"), tables)
    assert rows(made.new_rows, "name", "compound_class", "description") == {
        ("pep2", "peptide", "Proteomics"), ("met", "metabolite", "Metabolomics")
    }
    sets = T.load_datasets(of_type(files, COMPOUND_TYPES), tables, "x")
    known = {**tables, "compounds": after(tables["compounds"], made), "datasets": after(tables["datasets"], sets)}
    data = T.load_compound_data(cells, known)
    assert sorted(r["compound_value"] for r in data.new_rows.collect()) == [1.5, 2.5, 3.5, 9.0] and data.rejects.count() == 0
    known["compounddata"] = data.new_rows
    assert T.load_compound_data(cells, known).new_rows.count() == 0


def test_phenotype_loads(spark, folder, files, lines, tables):
    key = S.read_sheet(spark, f"{folder}/Phenotypes_README.csv")
    cells = S.read_long(of_type(lines, TRIAL_TYPES), ["ID"])
    unit_file = spark.createDataFrame([("kg", "kilogram", "mass")], "unit_abbreviation string, unit_name string, unit_description string")
    units = T.load_units(cells, key, unit_file, tables)
    assert rows(units.new_rows, "unit_abbreviation", "unit_name") == {("kg", "kilogram"), ("cm", None)}
    known = {**tables, "units": after(tables["units"], units)}
    traits = T.load_phenotypes(cells, key, known)
    assert rows(traits.new_rows, "name", "short_name", "datatype") == {
        ("Yield;1", "yield;1", "float"), ("Index;5Sep", "NDVI;5Sep", "int")
    }
    known["phenotypes"] = after(tables["phenotypes"], traits)
    known["datasets"] = after(tables["datasets"], T.load_datasets(of_type(files, TRIAL_TYPES), tables, "x"))
    data = T.load_phenotype_data(cells, key, known)
    assert data.new_rows.count() == 6 and data.rejects.count() == 1
    assert rows(data.new_rows.where("phenotype_value = '0.5'"), "germinatebase_id", "location_id") == {(4, 2)}
    known["phenotypedata"] = data.new_rows
    again = T.load_phenotype_data(cells, key, known)
    assert again.new_rows.count() == 0 and again.report().first()["rows_added"] == 0


def test_vocabularies_settle(spark):
    for target, (fixed, schema, _) in VOCABULARIES.items():
        stored = spark.createDataFrame([], f"id int, {schema}")
        first = load_vocabulary(target, stored)
        assert first.new_rows.count() == len(fixed)
        assert load_vocabulary(target, after(stored, first)).new_rows.count() == 0


@pytest.fixture(scope="module")
def tree_sheets(spark):
    accession = "Accession_ID string, Accession_name string, Parent_ID string, " + ", ".join(f"{c} string" for c in E.ACCESSION_ATTRIBUTES) + ", row int"
    blank = [None] * 10
    return {
        "Accession": spark.createDataFrame(
            [("IW_A1", "one", None, "x/y", *blank, "n", 0), ("IW_A2", "two", "IW_A1", None, *blank, None, 1), ("IW_A2", "dup", None, None, *blank, None, 2)],
            accession,
        ),
        "Plant_Plot": spark.createDataFrame(
            [("IW_P1", None, "IW_A1", "GES 2018", 0), ("IW_P2", "p2", None, "Obregon", 1), ("IW_P3", "p3", "IW_A2", None, 2)],
            "PlantPlot_ID string, PlantPlot_Name string, Accession_ID string, Experiment_Location string, row int",
        ),
        "Sample": spark.createDataFrame(
            [
                ("IW_S1", "s1", "plant", "IW_P1", None, "Frozen Leaf", None, "leaf", "Z30", None, 0),
                ("IW_S2", None, "plant2", "IW_P1", "IW_S1", "DNA", "x", None, None, "kept", 1),
                ("IW_S3", None, None, "IW_P1", None, None, None, "leaf", "Z31", "Surplus Sample Number", 2),
            ],
            "Sample_ID string, Sample_Name string, Plant_Name string, PlantPlot_ID string, Parent_ID string, Sample_Type string, Purpose string, Tissue string, Stage string, Notes string, row int",
        ),
        "GrainPacket": spark.createDataFrame(
            [("IW_G1", "IW_P1", "IW_A1", "g", 0), ("IW_G2", None, "IW_A2", "g", 1), ("IW_G3", None, None, "g", 2)],
            "GrainPacket_ID string, PlantPlot_ID string, Accession_ID string, Accession_Name string, row int",
        ),
    }


def test_entity_tree(spark, tree_sheets):
    tables = {
        "germinatebase": spark.createDataFrame(
            [], "id long, general_identifier string, number string, name string, entitytype_id int, entityparent_id long, location_id int"
        ),
        "attributedata": spark.createDataFrame([], "attribute_id int, foreign_id long, value string, created_on string"),
    }
    kinds = {"accessions", "plots", "samples", "grain"}
    found = E.load_tree(tree_sheets, tables, "2020-01-01", kinds)
    counts = {kind: result.new_rows.count() for kind, result in found.items()}
    assert counts == {
        "accessions": 2, "accession_attributes": 2, "plots": 2, "samples": 2, "sample_attributes": 5, "grain": 2,
    }
    entity = tables["germinatebase"]
    for kind in ("accessions", "plots", "samples", "grain"):
        entity = entity.unionByName(found[kind].new_rows, allowMissingColumns=True).select(entity.columns)
    ids = {r["general_identifier"]: r for r in entity.collect()}
    assert len({r["id"] for r in ids.values()}) == 8
    assert ids["IW_A2"]["name"] == "two" and ids["IW_P1"]["name"] == "" and ids["IW_S2"]["name"] == "plant2"
    assert ids["IW_P1"]["entityparent_id"] == ids["IW_A1"]["id"] and ids["IW_P1"]["location_id"] == 6
    assert ids["IW_G2"]["entityparent_id"] == ids["IW_A2"]["id"] and "IW_G3" not in ids
    parents = {r["general_identifier"]: r["entityparent_id"] for r in E.sample_parents(tree_sheets["Sample"], entity).collect()}
    assert parents["IW_S2"] == ids["IW_S1"]["id"] and parents["IW_S1"] == ids["IW_P1"]["id"]
    assert parents["IW_P1"] == ids["IW_A1"]["id"]
    up = {r["general_identifier"]: r["entityparent_id"] for r in E.accession_parents(tree_sheets["Accession"], entity).collect()}
    assert up["IW_A2"] == ids["IW_A1"]["id"]
    known = {"germinatebase": entity, "attributedata": found["accession_attributes"].new_rows.unionByName(found["sample_attributes"].new_rows)}
    again = E.load_tree(tree_sheets, known, "2020-01-02", kinds)
    assert all(result.new_rows.count() == 0 for result in again.values())
    values = rows(found["sample_attributes"].new_rows, "attribute_id", "value")
    assert values == {(13, "Frozen Leaf"), (13, "DNA Extraction"), (14, "Z30"), (15, "leaf"), (12, "kept")}


def test_bin_values_and_missing(spark, tables):
    sheet = spark.createDataFrame([("pep", 1.0, float("nan")), ("other", 2.0, 3.0)], "name string, IW_S1 double, IW_S2 double")
    found = E.load_bin_values(sheet, tables, "now")
    assert rows(found.new_rows, "compound_id", "germinatebase_id", "compound_value") == {(1, 5, 1.0)}
    assert found.rejects.count() == 2
    assert E.load_bin_values(sheet, tables, "now", keep_missing=True).new_rows.count() == 2


def test_table_sinks(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    path = str(tmp_path / "t")
    TB.append(frame, path)
    TB.append(frame, path)
    assert TB.verify_load(spark, path).first()["rows"] == 4
    with pytest.raises(Exception):
        TB.replace(frame, path)
    TB.replace(frame, str(tmp_path / "t2"))
    assert TB.read_tables(spark, str(tmp_path), ["t", "t2"])["t2"].count() == 2
    TB.write_csv(frame, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["id", "v"]
    assert cut_lineage(frame).count() == 2
    frame.createOrReplaceTempView("plain_view")
    assert "plain_view" in TB.list_tables(spark)
    new = spark.createDataFrame([(1, None), (3, "z")], "id int, v string")
    assert rows(TB.update_column(frame, new, "id", "v"), "id", "v") == {(1, None), (2, "b")}
