from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobweave.operators import ranking, splits


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows and a third of the values in one group."""
    rng = random.Random(7)
    rows = [("hot" if i % 3 == 0 else f"g{i % 5}", rng.choice([1.5, rng.random() * 100, -3.0])) for i in range(3000)]
    return spark.createDataFrame(rows, "g string, v double"), rows


def test_running_sums_equal_a_plain_loop(skewed):
    frame, rows = skewed
    counts = frame.groupBy("g", "v").agg(F.count("*").alias("n"))
    got = ranking.running_sums(counts, "v", ["n"], ["g"], buckets=16).collect()
    for r in got:
        mine = [v for g, v in rows if g == r["g"]]
        assert r["n_before"] == sum(v < r["v"] for v in mine)
        assert r["n_total"] == len(mine)


def test_quantiles_are_exact(skewed):
    frame, rows = skewed
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    for r in ranking.quantiles(frame, "v", probabilities, ["g"], buckets=16).collect():
        mine = [v for g, v in rows if g == r["g"]]
        want = np.quantile(mine, probabilities)
        assert [r[f"q{i}"] for i in range(6)] == pytest.approx(list(want))


def test_quantiles_of_equal_and_of_single_values(spark):
    frame = spark.createDataFrame([(2.0,)] * 5, "v double")
    r = ranking.quantiles(frame, "v", [0.25, 0.5]).first()
    assert (r["n"], r["q0"], r["q1"]) == (5, 2.0, 2.0)


def test_stratified_split_is_exact_per_class(spark):
    rows = [(i, "a" if i % 3 == 0 else f"c{i % 4}") for i in range(500)] + [(1000, "single")]
    frame = spark.createDataFrame(rows, "id long, y string")
    out = splits.stratified_split(frame, "y", "id", 0.8).collect()
    assert len(out) == len(rows)
    for klass in {y for _, y in rows}:
        n = sum(y == klass for _, y in rows)
        train = sum(r["is_train"] for r in out if r["y"] == klass)
        assert train == int(n * 0.8 + 0.5)


def test_split_does_not_depend_on_partitioning(spark):
    frame = spark.range(1000).withColumn("y", F.col("id") % 2)
    a = {r["id"]: r["is_train"] for r in splits.stratified_split(frame.repartition(3), "y", "id").collect()}
    b = {r["id"]: r["is_train"] for r in splits.stratified_split(frame.repartition(7), "y", "id").collect()}
    assert a == b
    h = splits.hash_split(frame, "id").where("is_train").count()
    assert 740 < h < 860


def test_half_split(spark):
    ids = [3, 9, 27, 81, 243, 729, 2187]
    frame = spark.createDataFrame([(i,) for i in ids], "id long")
    out = {r["id"]: r["is_first_half"] for r in splits.half_split(frame, "id").collect()}
    assert [i for i in ids if out[i]] == [3, 9, 27]


@pytest.mark.parametrize("kind", ["string", "bigint", "date"])
def test_half_split_on_keys_of_any_type(spark, kind):
    key = {"string": "concat('job', id * 37 % 1001)", "bigint": "id * 37 % 1001 + 3000000000", "date": "date_add(date'2000-01-01', cast(id * 37 % 1001 as int))"}[kind]
    frame = spark.range(1001).selectExpr(f"{key} as k").unionByName(spark.sql(f"select cast(null as {kind}) as k"))
    rows = splits.half_split(frame, "k").collect()
    ordered = sorted(r["k"] for r in rows if r["k"] is not None)
    assert sorted(r["k"] for r in rows if r["is_first_half"]) == ordered[:500]
    assert not splits.half_split(frame.limit(0), "k").collect()


def test_weights_and_guards(spark):
    frame = spark.createDataFrame([("a",)] * 3 + [("b",)], "y string")
    weights = {r["y"]: r["weight"] for r in splits.balanced_weights(frame, "y").collect()}
    assert weights == {"a": pytest.approx(4 / 6), "b": pytest.approx(2.0)}
    with pytest.raises(ValueError):
        splits.check_training_rows(frame.where("y = 'a'"), "y")
    with pytest.raises(ValueError):
        splits.check_training_rows(frame, "y", min_rows=10)
    with pytest.raises(ValueError):
        splits.drop_nulls(frame, ["missing"])


@pytest.mark.parametrize("kind", ["string", "long", "double", "date"])
def test_numbers_in_order(spark, kind):
    value = {"string": "concat('job', lpad(cast(id * 7 % 500 as string), 6, '0'))", "long": "id * 7 % 500 - 250", "double": "(id * 7 % 500) / 3", "date": "date_add(date'2020-01-01', cast(id * 7 % 500 as int))"}[kind]
    frame = spark.range(1500).selectExpr(f"cast({value} as {kind}) as v").union(spark.sql(f"select cast(null as {kind})"))
    rows = ranking.numbered_in_order(frame, "v", "n").collect()
    assert [r["v"] for r in sorted(rows, key=lambda r: r["n"])] == sorted({r["v"] for r in rows}) and sorted(r["n"] for r in rows) == list(range(500))
    assert ranking.numbered_in_order(frame.limit(0), "v", "n").count() == 0


def test_levels_of_one_prefix_spread_over_tasks(spark):
    """A million levels that begin alike: the stretches between the splitters are of one size."""
    levels = spark.range(0, 1_000_000, 1, 8).selectExpr("concat('job', lpad(cast(id as string), 9, '0')) as level")
    cuts = ranking.order_cuts(levels, "level", 64)
    sizes = [r["n"] for r in levels.groupBy(F.size(F.filter(cuts, lambda c: c < F.col("level"))).alias("s")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= 60 and max(sizes) < 4 * sorted(sizes)[len(sizes) // 2]
