import pytest
from pyspark.sql import functions as F

from plotloom.operators import keys as K
from plotloom.operators import numbering as N
from plotloom.operators import reshape as R
from plotloom.operators import stats as A


@pytest.fixture(scope="module")
def dim(spark):
    rows = [(1, "a", "first"), (2, "a", "second"), (3, None, "null key"), (4, "b", None), (5, "b", "later")]
    return spark.createDataFrame(rows, "id int, k string, v string")


@pytest.fixture(scope="module")
def left(spark):
    return spark.createDataFrame([(0, "a"), (1, "b"), (2, None), (3, "zz"), (4, "a")], "row int, key string")


@pytest.mark.parametrize("salts", [0, 5])
def test_lookup_takes_the_first_match_and_keeps_the_row_count(left, dim, salts):
    found = K.lookup(left, dim, "key", "k", {"v": "v", "id": "id"}, ["id"], salts=salts)
    assert {r["row"]: (r["v"], r["id"]) for r in found.collect()} == {
        0: ("first", 1), 1: (None, 4), 2: ("null key", 3), 3: (None, None), 4: ("first", 1),
    }


def test_lookup_latest_and_hot_key(spark, dim):
    hot = spark.range(5000).select(F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, "b").otherwise("a").alias("key"))
    found = K.lookup(hot, dim, "key", "k", {"v": "v"}, ["id"], latest=True, salts=8)
    assert {(r["v"], r["n"]) for r in found.groupBy("v").agg(F.count("*").alias("n")).collect()} == {("later", 1667), ("second", 3333)}


def test_fallback_needs_a_value_not_only_a_match(spark):
    dim = spark.createDataFrame([(None, "x", None), (7, None, "x"), (8, "y", "x")], "id int, code string, name string")
    left = spark.createDataFrame([("x",), ("y",), ("q",)], "key string")
    found = K.lookup_fallback(left, dim, "key", ["code", "name"], "id", "found", ["id"])
    assert {r["key"]: r["found"] for r in found.collect()} == {"x": 7, "y": 8, "q": None}


def test_any_of_falls_back_per_value(spark):
    dim = spark.createDataFrame([("p", None, 4), ("q", 2, 5)], "k string, loc int, inst int")
    left = spark.createDataFrame([("p", "q"), ("z", "q")], "one string, two string")
    found = K.lookup_any_of(left, dim, ["one", "two"], "k", {"loc": "loc", "inst": "inst"}, ["inst"])
    assert {r["one"]: (r["loc"], r["inst"]) for r in found.collect()} == {"p": (2, 4), "z": (2, 5)}


def test_only_new_is_null_safe_and_settles(left):
    stored = left.where("key is null or key = 'a'").select("key")
    new = K.only_new(left, stored, ["key"])
    assert sorted(r["key"] for r in new.collect()) == ["b", "zz"]
    assert K.only_new(left, left, ["key"]).count() == 0
    assert K.only_known(left, stored, ["key"]).count() == 3


def test_denormalise_keeps_both_sides(spark):
    fact = spark.createDataFrame([(1, 10.0), (None, 20.0)], "compound_id int, value double")
    dim = spark.createDataFrame([(1, "one"), (2, "two")], "id int, name string")
    rows = K.denormalise(fact, [("compound_id", "_c", dim)]).collect()
    assert {(r["compound_id"], r["value"], r["name"]) for r in rows} == {(1, 10.0, "one"), (2, None, "two"), (None, 20.0, None)}


def test_ids_are_dense_repeatable_and_follow_the_stored_ones(spark, monkeypatch):
    monkeypatch.setattr(N, "RUN_LENGTH", 7)
    rows = spark.range(3000).select((F.col("id") % 500).cast("string").alias("k"), F.when(F.col("id") % 3 == 0, "hot").alias("v"))
    hot = rows.unionByName(spark.range(1000).select(F.lit("same").alias("k"), F.lit("copy").alias("v")))
    stored = spark.createDataFrame([(40,), (17,)], "id int")
    one = N.assign_ids(hot, stored)
    ids = [r["id"] for r in one.select("id").collect()]
    assert sorted(ids) == list(range(41, 41 + 4000))
    assert one.select("k", "v").exceptAll(hot).count() == 0
    assert one.exceptAll(N.assign_ids(hot.repartition(5), stored)).count() == 0
    assert N.assign_ids(hot, stored.where("id < 0")).agg(F.min("id")).first()[0] == 1


def test_vocabulary_index_follows_first_sighting(spark):
    words = spark.range(10000).select(F.col("id").alias("pos"), F.when(F.col("id") % 7 != 0, F.concat(F.lit("w"), ((9999 - F.col("id")) % 321).cast("string"))).alias("w"))
    found = {r["w"]: (r["first_pos"], r["index"]) for r in A.vocabulary(words, "w", "pos").collect()}
    seen = []
    for row in words.orderBy("pos").collect():
        if row["w"] is not None and row["w"] not in seen:
            seen.append(row["w"])
    assert [found[w][1] for w in seen] == list(range(len(seen)))


def test_to_long_and_back(spark):
    wide = spark.createDataFrame([("p", 1, None), ("q", 3, 2.5)], "id string, a int, `b.c` double")
    long = R.to_long(wide, ["id"])
    assert {tuple(r) for r in long.collect()} == {("p", "a", "1"), ("p", "b.c", None), ("q", "a", "3"), ("q", "b.c", "2.5")}
    assert R.to_long(wide, ["id"], drop_nulls=True).count() == 3
    assert R.to_long(wide.drop("id"), []).count() == 4
    back = R.to_wide(long, ["id"], "name", ["a", "b.c"], F.first("value"))
    assert {tuple(r) for r in back.collect()} == {("p", "1", None), ("q", "3", "2.5")}


def test_mean_is_strict_about_nulls(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0), ("b", 4.0)], "k string, v double")
    assert {r["k"]: r["m"] for r in rows.groupBy("k").agg(A.mean_strict("v").alias("m")).collect()} == {"a": None, "b": 3.0}


def test_histogram_counts_everything_once(spark):
    rows = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 9, 10, 10)], "v double")
    assert {r["bin"]: r["n"] for r in A.histogram(rows, [], "v", 10).collect()} == {0: 1, 1: 1, 2: 1, 9: 3}
    one = spark.createDataFrame([("g", 5.0), ("g", 5.0), ("h", None)], "k string, v double")
    assert [tuple(r) for r in A.histogram(one, ["k"], "v", 4).collect()] == [("g", 0, 2)]


def test_interval_matches_linear_interpolation(spark):
    import numpy as np

    values = np.random.default_rng(1).normal(size=501)
    frame = spark.createDataFrame([("a", float(v)) for v in values] + [("a", None)], "k string, v double")
    row = A.interval(frame, ["k"], ["v"]).first()
    assert row["v_lo"] == pytest.approx(np.quantile(values, 0.025)) and row["v_hi"] == pytest.approx(np.quantile(values, 0.975))


def test_best_by_breaks_ties_by_order(spark):
    rows = spark.createDataFrame([("g", 2, 5.0), ("g", 1, 5.0), ("g", 0, None), ("g", 3, float("nan"))], "k string, i int, s double")
    assert tuple(A.best_by(rows, ["k"], "s", ["i"]).first()) == ("g", 1, 5.0)


def test_sample_groups_keeps_whole_groups(spark):
    rows = spark.range(1000).select((F.col("id") % 50).alias("g"), "id")
    one, two = A.sample_groups(rows, ["g"], 9, "x"), A.sample_groups(rows.repartition(3), ["g"], 9, "x")
    assert one.count() == 180 and one.exceptAll(two).count() == 0


def test_growth_rate_steps(spark):
    rows = spark.createDataFrame([("g", 1.0, 2.0), ("g", 3.0, 8.0), ("g", 3.0, 8.0), ("g", 4.0, 0.0)], "k string, x double, y double")
    steps = {r["x"]: r["rgr"] for r in A.stepwise_rgr(rows, ["k"], "x", "y").collect()}
    import math

    assert steps[1.0] is None and steps[3.0] == pytest.approx(math.log(4) / 2) and steps[4.0] is None


def test_hot_third_keeps_every_row(spark):
    """A third of the rows share one key, a tenth have none; counts stay whole on every route."""
    rows = spark.range(30000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, None).otherwise(F.col("id").cast("string")).alias("k")
    )
    dim = rows.select(F.col("k").alias("dk"), "id")
    for salts in (0, 16):
        found = K.lookup(rows, dim, "k", "dk", {"first": "id"}, ["id"], salts=salts)
        total, hot, missing = found.agg(
            F.count("*"), F.sum(F.when(F.col("k") == "hot", F.col("first"))), F.max(F.when(F.col("k").isNull(), F.col("first")))
        ).first()
        assert (total, hot, missing) == (30000, 0, 1)
    assert K.only_new(rows, rows.where("k = 'hot' or k is null"), ["k"]).count() == rows.where("k <> 'hot'").count()
    parts = dim.select(F.col("id").alias("v"), F.col("dk").alias("k")).groupBy("k").agg(F.min("v").alias("id"))
    joined = K.denormalise(rows.select("id", F.col("id").alias("n")), [("id", "_d", parts)])
    assert joined.count() == 30000


def test_no_join_is_a_nested_loop(spark, left, dim):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        frames = [
            K.lookup(left, dim, "key", "k", {"v": "v"}, ["id"]),
            K.only_new(left, dim, {"key": "k"}),
            K.lookup_fallback(left, dim, "key", ["k", "v"], "id", "found", ["id"]),
            K.denormalise(left.withColumnRenamed("row", "x"), [("x", "_d", dim)]),
        ]
        for frame in frames:
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert "NestedLoop" not in plan and "CartesianProduct" not in plan
        # the exchange of the reduction is the one of the join: one per side
        assert frames[0]._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
        assert frames[1]._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_denormalise_grows_by_one_join_per_dimension(spark):
    fact = spark.createDataFrame([(1, 2, 3, 4, 5, 6), (1, 2, None, 9, 9, 9)], "a int, b int, c int, d int, e int, f int")
    dim = spark.createDataFrame([(i, f"n{i}") for i in range(1, 9)], "id int, name string")

    def joins(columns):
        plan = K.denormalise(fact, [(c, f"_{c}", dim) for c in columns])._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("Join ")

    assert joins("abcdef") == 2 * joins("abc") == 12


def test_ids_do_not_depend_on_the_number_of_copies(spark, monkeypatch):
    rows = spark.createDataFrame([(v,) for v in "aaaaabbbcm"], "v string")
    none = spark.createDataFrame([], "id long, v string")
    expected = sorted(tuple(r) for r in N.assign_ids(rows, none).collect())
    monkeypatch.setattr(N, "RUN_LENGTH", 2)
    assert sorted(tuple(r) for r in N.assign_ids(rows, none).collect()) == expected
    assert [i for i, _ in expected] == list(range(1, 11))


def test_rows_of_the_default_are_spread(spark):
    """Nearly all keys are missing: the rows of the default row are not in one partition."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    dim = spark.createDataFrame([(1, "a"), (2, "No Parent"), (3, "No Parent")], "id int, name string")
    key = F.when(F.col("id") % 100 == 0, "a").when(F.col("id") % 100 == 1, "zz").when(F.col("id") % 100 == 2, "No Parent")
    rows = spark.range(4000).select(F.col("id").alias("row"), key.alias("parent"))
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        found = K.lookup_or_default(rows, dim, "parent", "No Parent", "name", {"parent_id": "id"}, ["id"])
        got = found.withColumn("at", F.spark_partition_id()).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sorted((r.row, r.parent, r.parent_id) for r in got) == [
        (i, {0: "a", 1: "zz", 2: "No Parent"}.get(i % 100), {0: 1, 1: None}.get(i % 100, 2)) for i in range(4000)
    ]
    sizes = [sum(r.at == at for r in got) for at in {r.at for r in got}]
    assert max(sizes) < 0.7 * len(got)
