"""Keyed-hash sampling (R1-R8, P14): exact sizes, brute-force equality, invariance."""

from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from petalframe.functions.rand import hash_rank
from petalframe.operators import sampling


def _frame(spark, counts):
    rows, i = [], 0
    for label, n in counts.items():
        for _ in range(n):
            rows.append((i, label, float(i % 17)))
            i += 1
    return spark.createDataFrame(rows, "id bigint, species string, x double")


def test_split_quotas_largest_remainder(spark):
    counts = spark.createDataFrame([("setosa", 56), ("versicolor", 59), ("virginica", 55)], "species string, _n long")
    q = {r["species"]: r["_k"] for r in sampling.split_quotas(counts, ["species"], 0.4).collect()}
    assert q == {"setosa": 22, "versicolor": 24, "virginica": 22}


@pytest.mark.parametrize("digits", [1, 2, 5])
def test_split_exact_and_equal_to_brute_force(spark, digits):
    df = _frame(spark, {"a": 56, "b": 59, "c": 55, "d": 1})
    out = sampling.stratified_split(df, "id", "species", 0.4, seed=42, digits=digits)
    rows = out.collect()
    assert len(rows) == df.count()
    test = Counter(r["species"] for r in rows if r["split"] == "test")
    assert sum(test.values()) == 69  # ceil(171 * 0.4)
    # brute force: smallest hashes per stratum, one window per stratum
    q = {r["species"]: r["_k"] for r in sampling.split_quotas(
        df.groupBy("species").agg(F.count("*").alias("_n")), ["species"], 0.4).collect()}
    w = Window.partitionBy("species").orderBy(hash_rank(42, "split", "id"), "id")
    bf = df.withColumn("rn", F.row_number().over(w)).collect()
    want = {r["id"] for r in bf if r["rn"] <= q[r["species"]]}
    assert {r["id"] for r in rows if r["split"] == "test"} == want


@pytest.mark.parametrize("n,p,k", [(120, 5, 6), (120, 50, 60), (10, 25, 2), (30, 5, 2), (50, 1, 0), (40, 100, 40)])
def test_exact_k_half_even(spark, n, p, k):
    df = spark.range(n).withColumnRenamed("id", "key")
    got = sampling.sample_exact_k(df, "key", p, seed=7, digits=1).where("sampled").count()
    assert got == k  # 2.5 -> 2 and 1.5 -> 2: round half to even


def test_poison_properties(spark):
    df = _frame(spark, {"a": 40, "b": 40, "c": 40}).withColumn("y", F.col("x") * 2)
    out = sampling.poison(df, "id", ["x", "y"], "species", 10, seed=52, digits=1)
    rows = {r["id"]: r for r in out.collect()}
    orig = {r["id"]: r for r in df.collect()}
    flagged = [i for i, r in rows.items() if r["is_poisoned"] == 1]
    assert len(flagged) == 12
    lo, hi = min(r["x"] for r in orig.values()), max(r["x"] for r in orig.values())
    for i, r in rows.items():
        if r["is_poisoned"]:
            assert r["species"] != orig[i]["species"]
            assert lo <= r["x"] <= hi
        else:
            assert (r["x"], r["y"], r["species"]) == (orig[i]["x"], orig[i]["y"], orig[i]["species"])
    zero = sampling.poison(df, "id", ["x"], "species", 0, seed=42)
    assert zero.where("is_poisoned = 1").count() == 0


def test_poison_two_classes_and_runs(spark):
    df = _frame(spark, {"a": 30, "b": 30})
    out = sampling.poison_runs(df, "id", ["x"], "species", [(1, 0, 42), (2, 50, 92), (3, 100, 142)], digits=1)
    c = {r["run_id"]: r["n"] for r in out.groupBy("run_id").agg(F.sum("is_poisoned").alias("n")).collect()}
    assert c == {1: 0, 2: 30, 3: 60}
    flipped = out.where("run_id = 3").collect()
    orig = {r["id"]: r["species"] for r in df.collect()}
    assert all(r["species"] != orig[r["id"]] for r in flipped)


def test_balanced_groups_and_invariance(spark):
    df = spark.range(101).withColumnRenamed("id", "doc_id")
    a = {r["doc_id"]: r["group"] for r in sampling.balanced_groups(df.repartition(1), "doc_id", 2, 42, digits=1).collect()}
    b = {r["doc_id"]: r["group"] for r in sampling.balanced_groups(df.repartition(17), "doc_id", 2, 42, digits=2).collect()}
    assert a == b
    sizes = Counter(a.values())
    assert abs(sizes[0] - sizes[1]) <= 1


def test_surrogate_key_dense(spark):
    df = spark.createDataFrame([(k * 7 + 3,) for k in range(500)], "okey bigint").repartition(5)
    out = sampling.surrogate_key(df, ["okey"], n_ranges=16).collect()
    got = sorted((r["okey"], r["row_id"]) for r in out)
    assert [rid for _, rid in got] == list(range(500))


def test_surrogate_key_hot_first_column(spark):
    """A third of the rows share the first order column: ids stay dense and
    ordered, and no numbered range holds the hot value's rows alone."""
    rows = [(0 if i < 400 else 1 + i % 50, i) for i in range(1200)]
    df = spark.createDataFrame(rows, "day int, id long").repartition(4)
    out = sampling.surrogate_key(df, ["day", "id"], n_ranges=8)
    got = sorted((r["day"], r["id"], r["row_id"]) for r in out.collect())
    assert [r[2] for r in got] == list(range(1200))
    per_range = (df.repartitionByRange(8, "day", "id").groupBy(F.spark_partition_id().alias("p")).count()
                 .agg(F.max("count")).first()[0])
    assert per_range < 400


def test_null_stratum_keeps_its_rows(spark):
    from petalframe.operators.sampling import stratified_split

    df = spark.range(100).selectExpr("id", "case when id % 10 = 0 then null else id % 3 end as s")
    out = stratified_split(df, "id", "s", 0.2, seed=1)
    assert out.count() == 100 and out.where("s is null").count() == 10
    assert out.where("split = 'test'").count() == 20 and out.where("s is null and split = 'test'").count() == 2


def test_repeated_keys_are_an_error_not_a_wrong_count(spark):
    same = spark.createDataFrame([(7, float(i)) for i in range(1000)], "id int, v double")
    with pytest.raises(ValueError, match="unique"):
        sampling.sample_exact_k(same, "id", 10, 42)
    assert sampling.sample_exact_k(same, "id", 100, 42).where("sampled").count() == 1000  # nothing to tell apart
    assert sampling.sample_exact_k(same, ["id", "v"], 10, 42).where("sampled").count() == 100
