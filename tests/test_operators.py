import random
from datetime import datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from clinicmart.operators import joins, keys, quality, rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def as_set(df):
    return {tuple(r) for r in df.collect()}


# ----------------------------------------------------------------------- rows


def test_first_row_decides_and_may_remove_its_key(spark):
    df = spark.createDataFrame(
        [(1, "a", None), (2, "a", "x"), (3, "b", "y"), (4, "b", None), (5, None, "z"),
         (6, None, None), (7, "c", "w")],
        "orden int, k string, estado string",
    )
    got = rows.first_complete(df, ["k"], ["k", "estado"], ["orden"])
    assert as_set(got) == {(3, "b", "y"), (7, "c", "w")}


def test_first_per_key_keeps_one_row_of_the_null_key(spark):
    df = spark.createDataFrame([(2, None), (1, None), (3, "a")], "orden int, k string")
    assert as_set(rows.first_per_key(df, ["k"], ["orden"])) == {(1, None), (3, "a")}


def test_first_per_key_shrinks_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = plan_of(rows.first_per_key(df, ["k"], ["id"]))
    assert plan.index("Partial") > plan.index("Exchange hashpartitioning")


def test_present_and_first_present(spark):
    df = spark.createDataFrame([(1, 2)], "anio int, Year int")
    assert rows.present(df, ["x", "Year"]) == ["Year"]
    assert rows.first_present(df, ("dim_1", "anio", "Year"), "year") == "anio"
    with pytest.raises(ValueError, match="no year column"):
        rows.first_present(df, ("dim_1",), "year")


def test_distinct_sorted_preview_empty(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("b",), ("É",)], "v string")
    assert [r.v for r in rows.distinct_sorted(df, "v").collect()] == ["a", "b", "É"]
    assert [r.v for r in rows.preview(df, 2, [F.desc_nulls_last("v")]).collect()] == ["É", "b"]
    assert rows.is_empty(df.filter("false")) and not rows.is_empty(df)


# ----------------------------------------------------------------------- keys


@pytest.fixture(scope="module")
def numbered_input(spark):
    """Skewed on the first column, with nulls, unique over both."""
    random.seed(11)
    data = [("hot", i) for i in range(400)]
    data += [(random.choice(["a'\\n", "É\n", "z", None, ""]), 1000 + i) for i in range(600)]
    random.shuffle(data)
    return data, spark.createDataFrame(data, "a string, b bigint").repartition(7)


def expected_order(data):
    return sorted(data, key=lambda r: (r[0] is None, r[0] or "", r[1]))


@pytest.mark.parametrize("per_range", [10_000, 100, 16])
def test_dense_key_is_a_global_row_number(numbered_input, per_range):
    data, df = numbered_input
    got = keys.dense_key(df, ["a", "b"], "k", rows_per_range=per_range)
    assert [(r.a, r.b) for r in got.orderBy("k").collect()] == expected_order(data)
    assert sorted(r.k for r in got.collect()) == list(range(1, len(data) + 1))


def test_dense_key_splits_a_hot_value_over_ranges(numbered_input):
    _, df = numbered_input
    placed = keys.place_ranges(df, ["a", "b"], 20)
    hot = placed.filter("a = 'hot'").select("_range").distinct().count()
    largest = placed.groupBy("_range").count().agg(F.max("count")).first()[0]
    assert hot >= 5 and largest < df.count() / 5


def test_dense_key_over_ranges_needs_no_single_task(numbered_input):
    _, df = numbered_input
    got = keys.dense_key(df, ["a", "b"], "k", rows_per_range=100)
    plan = plan_of(got)
    # The only single partition is the running sum over one row per range.
    assert plan.count("Exchange SinglePartition") == 1
    below = plan.split("Exchange SinglePartition")[1]
    assert "functions=[max(_place" in below.split("FileScan")[0]


def test_dense_key_takes_one_way_at_every_size(numbered_input):
    _, df = numbered_input
    for small in (df, df.limit(3)):
        plan = plan_of(keys.dense_key(small, ["a", "b"], "k"))
        assert plan.count("Exchange SinglePartition") == 1
        assert "functions=[max(_place" in plan.split("Exchange SinglePartition")[1].split("FileScan")[0]


def test_dense_key_is_the_same_on_every_run(numbered_input):
    _, df = numbered_input
    got = keys.dense_key(df, ["a", "b"], "k", rows_per_range=50)
    assert as_set(got) == as_set(got)


def test_dense_key_of_nested_and_time_columns(spark):
    data = [(Row(file=f"f{i % 3}", row=i), datetime(2020, 1, 1 + i % 5)) for i in range(60)]
    df = spark.createDataFrame(data, "o struct<file: string, row: bigint>, t timestamp_ntz")
    got = keys.dense_key(df, ["t", "o"], "k", rows_per_range=5).orderBy("k").collect()
    assert [(r.t, r.o.file, r.o.row) for r in got] == sorted(
        (t, o.file, o.row) for o, t in data
    )


def test_dense_key_of_nothing(spark):
    assert keys.dense_key(spark.range(0), ["id"], "k").count() == 0


def test_dense_key_probe(numbered_input):
    data, df = numbered_input
    wide = df.withColumn("extra", F.col("b") * 2)
    got = keys.dense_key(wide, ["a", "b"], "k", rows_per_range=100, probe=df)
    assert [(r.a, r.b) for r in got.orderBy("k").collect()] == expected_order(data)


# ---------------------------------------------------------------------- joins


def test_lookup_matches_null_with_null(spark):
    left = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "id int, label string")
    right = spark.createDataFrame([(10, "x"), (20, None)], "key int, label string")
    got = joins.lookup(left, right, ["label"])
    assert as_set(got) == {(1, "x", 10), (2, None, 20), (3, "y", None)}
    assert got.columns == ["id", "label", "key"]


def test_broadcast_only_below_the_measured_size(spark):
    # Estimates of a computed side are far off; the measured size decides.
    side = spark.range(100).join(spark.range(100).withColumnRenamed("id", "j"), F.col("id") == F.col("j"))
    big = spark.range(10_000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = big.join(joins.broadcast_if_small(side), "id")
        large = big.join(joins.broadcast_if_small(side, max_bytes=10), "id")
        assert "BroadcastHashJoin" in plan_of(small)
        assert "BroadcastHashJoin" not in plan_of(large)
        assert small.count() == large.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# -------------------------------------------------------------------- quality


@pytest.fixture(scope="module")
def faulty(spark):
    return spark.createDataFrame(
        [(1, "a", 3.0), (1, None, -1.0), (2, "b", None), (None, "c", 0.0), (None, None, 1.0)],
        "k int, s string, d double",
    )


def test_null_profile(faulty):
    assert as_set(quality.null_profile(faulty, "t")) == {
        ("t", "k", 5, 2), ("t", "s", 5, 2), ("t", "d", 5, 1),
    }


def test_null_summary(faulty):
    row = quality.null_summary({"uno": faulty, "dos": faulty.filter("k = 2")}).first()
    assert (row.filas_uno, row.filas_dos) == (5, 1)
    assert row.nulos_uno.asDict() == {"k": 2, "s": 2, "d": 1}
    assert row.nulos_dos.asDict() == {"k": 0, "s": 0, "d": 1}


def test_uniqueness_counts_repeats_including_null(faulty):
    assert as_set(quality.uniqueness(faulty, ["k"], "r")) == {("r", "k", 2)}
    assert as_set(quality.uniqueness(faulty.filter("false"), ["k"], "r")) == {("r", "k", 0)}


def test_completeness_and_range(faulty):
    got = as_set(quality.completeness(faulty, ["k", "s"], "r", {"d": 0}))
    assert got == {("r", "k", 2), ("r", "s", 2), ("r", "d>=0", 2)}


def test_orphans(spark):
    fact = spark.createDataFrame(
        [(1, 7), (1, None), (9, 7), (9, 8), (None, 7)], "centro bigint, contexto bigint"
    )
    centers = spark.createDataFrame([(1,), (2,), (2,)], "c bigint")
    contexts = spark.createDataFrame([(7,)], "x bigint")
    refs = {"centro": (centers, "c"), "contexto": (contexts, "x")}
    assert as_set(quality.orphans(fact, refs, ["contexto"])) == {
        ("referencia", "centro", 3), ("referencia", "contexto", 1),
    }
    clean = quality.orphans(fact.filter("false"), refs)
    assert as_set(clean) == {("referencia", "centro", 0), ("referencia", "contexto", 0)}


def test_enforce(faulty):
    quality.enforce(quality.uniqueness(faulty.filter("k = 2"), ["k"], "r"))
    with pytest.raises(quality.QualityError, match=r"r \[k\]: 2"):
        quality.enforce(quality.uniqueness(faulty, ["k"], "r"))


def test_row_counts(spark, faulty):
    got = quality.row_counts({"a": faulty, "b": faulty.filter("false")})
    assert as_set(got) == {("a", 5), ("b", 0)}


def test_counts_taken_while_writing(spark, faulty, tmp_path):
    rules = (("r", ["k", "s"], {"d": 0}), ("q", [], {"k": 2}))
    counted = {"uno": quality.Counted(faulty, *rules), "dos": quality.Counted(faulty.filter("k = 2"))}
    for name, c in counted.items():
        c.df.write.parquet(str(tmp_path / name))
    assert counted["uno"].rows == 5 and counted["uno"].nulls() == {"k": 2, "s": 2, "d": 1}
    expected = quality.merge_reports(*[quality.completeness(faulty, c, r, m) for r, c, m in rules])
    assert as_set(counted["uno"].report()) == as_set(expected)
    assert as_set(counted["dos"].report()) == set()
    summary, plain = quality.counted_summary(counted), quality.null_summary({"uno": faulty, "dos": faulty.filter("k = 2")})
    assert summary.columns == plain.columns
    assert summary.first().asDict(True) == plain.first().asDict(True)


@pytest.mark.parametrize("values", [[], [1, 2, 3], [1, 1, 2, 70_000, 70_000, 70_000], [None, None, 5], [0, -1, -1]])
def test_unique_numbers(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "k bigint")
    assert as_set(quality.unique_numbers(df, "k", "r")) == as_set(quality.uniqueness(df, ["k"], "r"))


def test_fan_out(spark):
    left = spark.createDataFrame([("x",), ("x",), ("y",), (None,), ("w",)], "n string")
    right = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3), (None, 4), (None, 5), ("z", 6), ("z", 7)], "n string, k int")
    # Two rows meet two of x and one meets two nulls; z is not asked for.
    assert as_set(quality.fan_out(left, right, ["n"], "r")) == {("r", "n", 3)}
    assert as_set(quality.fan_out(left, right.filter("n = 'y'"), ["n"], "r")) == {("r", "n", 0)}


def test_labels_are_quoted(spark):
    df = spark.createDataFrame([(None,)], "`it's` string")
    assert as_set(quality.null_profile(df, "t'")) == {("t'", "it's", 1, 1)}


def test_ranges_are_released(spark, tmp_path):
    import glob

    from clinicmart.sources.store import work_root

    df = keys.dense_key(spark.range(50).withColumn("x", F.lit(1)), ["id"], "k")
    mine = {f.rsplit("/", 2)[0] for f in df.inputFiles()}
    assert len(mine) == 1 and df.count() == 50
    other = keys.dense_key(spark.range(3), ["id"], "k")
    keys.release(df)
    folder = work_root(spark).removeprefix("file:") + "/ranges/"
    left = {p.rsplit("/", 1)[1] for p in glob.glob(folder + "*")}
    assert mine.pop().rsplit("/", 1)[1] not in left and other.count() == 3


def test_stored_side_has_a_known_size(spark):
    big, small = spark.range(1000), spark.range(3).withColumn("v", F.lit("x"))
    joined = big.join(small.withColumnRenamed("id", "o"), F.col("id") == F.col("o")).select("id", "v")
    side = joins.stored_side(joined)
    plan = plan_of(big.withColumn("w", F.lit(1)).join(side, "id"))
    assert "BroadcastHashJoin" in plan and side.count() == 3
