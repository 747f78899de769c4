import datetime

import pytest
from pyspark.sql import functions as F

from plotloom.functions import domain as D
from plotloom.functions import scalar as S


def values(spark, rows, schema, *columns):
    frame = spark.createDataFrame(rows, schema).coalesce(1)
    return [tuple(row) for row in frame.select(*columns).collect()]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("a_b_c", ["a", "b", "c"]),
        ("a_b", ["a", "b", None]),
        ("a", ["a", None, None]),
        ("a_b_", ["a", "b", None]),
        ("a__c", ["a", "", "c"]),
        ("_b", ["", "b", None]),
        ("", [None, None, None]),
        (None, [None, None, None]),
    ],
)
def test_token_drops_only_a_trailing_empty_one(spark, text, expected):
    found = values(spark, [(text,)], "s string", *[S.token("s", "_", i).alias(str(i)) for i in (1, 2, 3)])
    assert list(found[0]) == expected


def test_replace_first_touches_one_occurrence(spark):
    rows = [("GES20 GES20",), ("none",), (None,), ("a\nGES20",)]
    found = values(spark, rows, "s string", S.replace_first("s", "GES20", "G$1\\"))
    assert [r[0] for r in found] == ["G$1\\ GES20", "none", None, "a\nG$1\\"]


def test_null_rules(spark):
    rows = [("x", None), (None, "y"), ("x", "y")]
    found = values(
        spark, rows, "a string, b string",
        S.glue("a", "b", separator="-"), S.if_else(F.col("a") == "x", F.lit(1), F.lit(2)), S.labelled_part("A", "a"),
    )
    assert found == [(None, 1, "A: x, "), (None, None, ""), ("x-y", 1, "A: x, ")]


def test_numbers_dates_and_division(spark):
    rows = [("1.5", "5sep2018"), ("NA", "31Feb2018"), ("NaN", "05SEP2018"), (" ", None)]
    found = values(spark, rows, "n string, d string", S.to_number("n"), S.to_date_dmy("d"), S.missing_to_null("n"))
    day = datetime.date(2018, 9, 5)
    assert found == [(1.5, day, "1.5"), (None, None, None), (None, day, None), (None, None, None)]
    zero = values(spark, [(1.0, 0.0)], "a double, b double", S.divide("a", "b"), S.finite(F.lit(float("inf"))), S.finite(F.lit(float("nan"))))
    assert zero == [(None, None, None)]


def test_hashed_normals_are_standard_and_independent_of_partitioning(spark):
    frame = spark.range(20000).select(F.col("id"), S.standard_normal(F.lit("s"), "id").alias("z"))
    again = spark.range(20000).repartition(7).select(F.col("id"), S.standard_normal(F.lit("s"), "id").alias("z"))
    assert frame.exceptAll(again).count() == 0
    mean, sd = frame.agg(F.avg("z"), F.stddev("z")).first()
    assert abs(mean) < 0.03 and abs(sd - 1) < 0.03


def test_site_and_dataset_rules(spark):
    rows = [("2017_GES_x_Harvest.csv",), ("2018_GES_x_Harvest.csv",), ("2016_Obregon_trial_Q2.csv",), ("bad.csv",)]
    files = D.file_name_parts(spark.createDataFrame(rows, "file string"))
    found = D.dataset_key(D.normalise_site(files)).orderBy("file").select("site_name_short", "description", "datatype").collect()
    assert [tuple(r) for r in found] == [
        ("Obregon", "CIMMYT2016", "Q2"),
        ("GES CR04", "GES17_x", "Harvest"),
        ("GES VR11", "GES18_x", "Harvest"),
        (None, None, None),
    ]


def test_experiment_code_and_location_rules(spark):
    found = values(
        spark, [(9, "GES17 near Obregon"), (23, "nowhere"), (None, None)], "n int, site string",
        D.experiment_code("n"), D.location_rule("site"),
    )
    assert found == [("IW_E0009", 2), ("IW_E0023", None), (None, None)]


def test_sample_class_order(spark):
    rows = [
        ("Frozen Leaf", "Backup"), ("Frozen Leaf", None), ("frozen leaf x", "Prot/Met"), ("frozen leaf", "other"),
        ("DNA", "other"), (None, "Q2 x"), (None, "original leaf y"), (None, None),
    ]
    found = values(spark, rows, "t string, p string", D.sample_class("t", "p"))
    assert [r[0] for r in found] == ["Backup", "Frozen Leaf", "Frozen Leaf", None, "DNA Extraction", "Q2", "Original Leaf", None]
