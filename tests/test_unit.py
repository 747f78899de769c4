"""Units of work: killed and run again, they leave the same tables."""

import pytest
from pyspark.sql import functions as F

from plotloom.plans import trials as T
from plotloom.plans.common import LoadResult, finish_load
from plotloom.sources import unit as U

CELLS = [("2016_GES_a_Harvest.csv", "P1", "yield_kg_1", "3"), ("2016_GES_a_Harvest.csv", "P2", "yield_kg_1", "4"), ("2016_GES_a_Harvest.csv", "P9", "height_cm", "7")]


def seed(spark, location):
    make = spark.createDataFrame
    unit = U.UnitOfWork(spark, location, "seed")
    unit.put("units", make([(3, "m", "metre", "length")], "id long, unit_abbreviation string, unit_name string, unit_description string"))
    unit.put("phenotypes", make([], "id long, name string, short_name string, description string, datatype string, unit_id string"))
    unit.put("phenotypedata", make([], "phenotype_id long, germinatebase_id int, phenotype_value string, dataset_id int, location_id int"))
    unit.commit()


def steps(spark, calls, fail_at=None):
    make = spark.createDataFrame
    cells = make(CELLS, "file string, ID string, name string, value string")
    key = make([("yield", "Yield", "kg"), ("height", "Height", "cm")], "short_name string, name string, Description string")
    unit_file = make([("kg", "kilogram", "mass")], "unit_abbreviation string, unit_name string, unit_description string")
    fixed = {
        "germinatebase": make([(1, "P1", "x"), (2, "P2", "y")], "id int, general_identifier string, name string"),
        "datasets": make([(9, "GES16_a Harvest")], "id int, description string"),
        "locations": make([(2, "GES VR11")], "id int, site_name_short string"),
    }

    def step(name, load):
        def run(unit):
            calls.append(name)
            if name == fail_at:
                raise KeyboardInterrupt("killed")
            return load({**fixed, **unit.tables(["units", "phenotypes", "phenotypedata"])})

        return run

    return {
        "units": step("units", lambda t: T.load_units(cells, key, unit_file, t)),
        "phenotypes": step("phenotypes", lambda t: T.load_phenotypes(cells, key, t)),
        "phenotypedata": step("phenotypedata", lambda t: T.load_phenotype_data(cells, key, t)),
    }


def contents(spark, location):
    return {
        name: sorted(map(str, U.read_committed(spark, location, name).collect())) for name in ("units", "phenotypes", "phenotypedata")
    }


def test_a_killed_unit_is_not_seen_and_ends_alike(spark, tmp_path):
    whole, broken = str(tmp_path / "whole"), str(tmp_path / "broken")
    for location in (whole, broken):
        seed(spark, location)
    before = contents(spark, broken)
    calls = []
    U.run_unit(spark, whole, "harvest 2016", steps(spark, calls))
    assert calls == ["units", "phenotypes", "phenotypedata"]
    with pytest.raises(KeyboardInterrupt):
        U.run_unit(spark, broken, "harvest 2016", steps(spark, [], fail_at="phenotypedata"))
    assert contents(spark, broken) == before
    # Half a write of the third table, with no journal row.
    junk = spark.createDataFrame([(1, 1, "junk", 1, 1)], "phenotype_id long, germinatebase_id int, phenotype_value string, dataset_id int, location_id int")
    junk.write.parquet(f"{broken}/phenotypedata/unit={U.unit_key('harvest 2016')}")
    assert contents(spark, broken) == before
    calls = []
    unit = U.run_unit(spark, broken, "harvest 2016", steps(spark, calls))
    assert calls == ["phenotypedata"]
    assert contents(spark, broken) == contents(spark, whole)
    assert [tuple(r) for r in unit.report().collect()] == [("phenotypedata", 2, 1), ("phenotypes", 2, 0), ("units", 2, 0)]
    assert unit.rejects("phenotypedata").count() == 1
    after = contents(spark, whole)
    calls = []
    U.run_unit(spark, whole, "harvest 2016", steps(spark, calls))
    assert calls == [] and contents(spark, whole) == after


def test_staged_rows_of_a_dead_unit_are_dropped_if_the_tables_have_changed(spark, tmp_path):
    location = str(tmp_path)
    seed(spark, location)
    with pytest.raises(KeyboardInterrupt):
        U.run_unit(spark, location, "first", steps(spark, [], fail_at="phenotypes"))
    other = U.UnitOfWork(spark, location, "other")
    other.put("units", spark.createDataFrame([(4, "kg", "k", "m")], "id long, unit_abbreviation string, unit_name string, unit_description string"))
    waiting = U.UnitOfWork(spark, location, "waiting")
    other.commit()
    with pytest.raises(RuntimeError, match="run it again"):
        waiting.commit()
    calls = []
    U.run_unit(spark, location, "first", steps(spark, calls))
    assert calls == ["units", "phenotypes", "phenotypedata"]
    units = U.read_committed(spark, location, "units").collect()
    assert sorted((r["id"], r["unit_abbreviation"]) for r in units) == [(3, "m"), (4, "kg"), (5, "cm")]


def test_rows_and_rejects_come_from_one_evaluation(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.createDataFrame([(i, i % 3 or None) for i in range(30)], "k int, v int")
    counted = rows.mapInArrow(count, "k int, v int")
    result = finish_load("t", counted, spark.createDataFrame([(0, 1, 1)], "id long, k int, v int"), ["k", "v"]).evaluated()
    assert (result.new_rows.count(), result.rejects.count()) == (19, 10)
    assert result.report().first()["rows_added"] == 19
    assert seen.value == 30


def test_a_table_without_rows_is_an_error(spark, tmp_path):
    with pytest.raises(KeyError):
        U.read_committed(spark, str(tmp_path), "none")
    unit = U.UnitOfWork(spark, str(tmp_path), "x")
    with pytest.raises(KeyError):
        unit.read("none")
    unit.put("t", spark.createDataFrame([], "a int"))
    unit.commit()
    more = U.UnitOfWork(spark, str(tmp_path), "y")
    made = more.stage("t", lambda: LoadResult("t", spark.createDataFrame([("5",)], "a string"), spark.createDataFrame([], "a string")))
    assert made.schema["a"].dataType.typeName() == "integer" and made.collect() == [(5,)]
    assert made.agg(F.sum("a")).first()[0] == 5
