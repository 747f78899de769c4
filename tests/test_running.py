"""Row numbers and steps between rows over ranges of sorted rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from plotloom.operators.numbering import number_rows, with_previous
from plotloom.operators.stats import stepwise_rgr

SCHEMA = "g string, h int, x int, y double"


@pytest.fixture
def many_ranges(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def long_rows():
    draw = random.Random(1)
    rows = [("long", 1, x, draw.uniform(1, 5)) for x in range(3000)] + [(None, None, x, draw.uniform(1, 5)) for x in range(40)]
    rows += [(f"g{i}", i % 3, x, draw.uniform(1, 5)) for i in range(50) for x in range(draw.randrange(1, 5))]
    draw.shuffle(rows)
    return rows


def test_the_row_before_is_found_across_ranges(spark, many_ranges):
    rows = long_rows()
    found = with_previous(spark.createDataFrame(rows, SCHEMA).repartition(5), ["g", "h"], "x", {"px": "x", "py": "y"})
    known = {(g, h, x): y for g, h, x, y in rows}
    got = found.collect()
    assert len(got) == len(rows) and found.columns == ["g", "h", "x", "y", "px", "py"]
    for r in got:
        before = known.get((r["g"], r["h"], r["x"] - 1))
        assert r["py"] == before and r["px"] == (None if before is None else r["x"] - 1)


def test_step_rates_of_a_long_group(spark, many_ranges):
    rows = long_rows()
    got = stepwise_rgr(spark.createDataFrame(rows, SCHEMA), ["g"], "x", "y").where("g = 'long'").collect()
    y = {x: v for g, _, x, v in rows if g == "long"}
    assert len(got) == 3000
    for r in got:
        want = None if r["x"] == 0 else math.log(y[r["x"]]) - math.log(y[r["x"] - 1])
        assert r["rgr"] == (None if want is None else pytest.approx(want, abs=1e-12))


def test_rows_are_numbered_in_order(spark, many_ranges):
    rows = long_rows()
    frame = spark.createDataFrame(rows, SCHEMA)
    got = number_rows(frame, [F.col("x").desc(), "y"], "n", 22).collect()
    want = sorted(rows, key=lambda r: (-r[2], r[3]))
    assert [(r["x"], r["y"]) for r in sorted(got, key=lambda r: r["n"])] == [(x, y) for *_, x, y in want]
    assert sorted(r["n"] for r in got) == list(range(23, 23 + len(rows)))
    assert number_rows(frame.limit(0), ["x"], "n").count() == 0


def test_no_window_spans_a_group(spark):
    frame = spark.createDataFrame(long_rows(), SCHEMA)
    for result in (stepwise_rgr(frame, ["g"], "x", "y"), number_rows(frame, ["x", "y"], "n")):
        plan = result._jdf.queryExecution().optimizedPlan().toString()
        assert all("__part" in line for line in plan.splitlines() if "Window [" in line)
