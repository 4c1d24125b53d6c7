import numpy as np
import pytest
from pyspark.sql import functions as F

from marketgrain.functions import order_stats as O

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.mark.parametrize("values", [
    list(range(1, 1001)),
    [5.0] * 700 + list(np.linspace(-3, 40, 301)),
    [1.0],
    [1.0, 2.0, 3.0, 10.0],
])
@pytest.mark.parametrize("probs", [[0.5], PROBS])
def test_quantiles_equal_numpy(spark, values, probs):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    row = O.exact_quantiles(df, [], "v", probs).first()
    assert row["n"] == len(values)
    assert np.allclose(row["quantiles"], np.quantile(values, probs))


def test_quantiles_per_key(spark):
    rng = np.random.default_rng(1)
    groups = {k: rng.normal(k, 1, 50 + k) for k in range(4)}
    df = spark.createDataFrame([(k, float(v)) for k, vs in groups.items() for v in vs], "k long, v double")
    for row in O.exact_quantiles(df, ["k"], "v", PROBS).collect():
        assert np.allclose(row["quantiles"], np.quantile(groups[row["k"]], PROBS))


def test_exact_with_a_coarse_sketch(spark):
    values = np.random.default_rng(2).exponential(size=5000)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    assert np.allclose(O.exact_quantiles(df, [], "v", [0.5, 0.9], accuracy=50).first()["quantiles"], np.quantile(values, [0.5, 0.9]))


def test_running_total_and_next_value(spark):
    rng = np.random.default_rng(3)
    at = np.unique(rng.integers(0, 100_000, 2000))
    counts = rng.integers(1, 9, len(at))
    df = spark.createDataFrame([(int(a), int(c)) for a, c in zip(at, counts)], "a long, c long")
    got = O.running_total(df, [], "a", {"c": "total"}, following="ahead").orderBy("a").collect()
    assert [r["total"] for r in got] == np.cumsum(counts).tolist()
    assert [r["ahead"] for r in got] == [*at[1:].tolist(), None]


def test_row_positions_with_ties(spark):
    df = spark.createDataFrame([(i % 2, i // 4, i) for i in range(200)], "k long, t long, id long")
    for key in (0, 1):
        rows = O.row_positions(df, ["k"], "t", ["id"], "pos").where(F.col("k") == key).orderBy("t", "id").collect()
        assert [r["pos"] for r in rows] == list(range(1, 101))


@pytest.mark.parametrize("limit", [O.BROADCAST_KEYS, 0])
def test_rows_are_never_shuffled_by_the_key_alone(spark, monkeypatch, limit):
    """Also where Spark itself would not broadcast."""
    monkeypatch.setattr(O, "BROADCAST_KEYS", limit)
    values = [(k, float(v)) for k in range(3) for v in range(400)]
    df = spark.createDataFrame(values, "k long, v double")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = O._beside(df.withColumn("_at", F.col("v")), df.groupBy("k").agg(F.array(F.min("v")).alias("_edges")), ["k"], F.col("v"))
        plan = found._jdf.queryExecution().executedPlan().toString()
        shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert all("_salt" in line for line in shuffled) and bool(shuffled) == (limit == 0)
        rows = O.exact_quantiles(df, ["k"], "v", PROBS).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert all(np.allclose(r["quantiles"], np.quantile(range(400), PROBS)) for r in rows) and len(rows) == 3


def test_wide_quantiles_equal_sorted_values(spark):
    rng = np.random.default_rng(12)
    columns = {f"c {k}": rng.normal(size=3000).round(k % 4) * (k + 1) for k in range(18)}
    columns["c 3"] = np.where(rng.random(3000) < 0.4, 7.0, columns["c 3"])
    rows = [tuple(None if k == 5 and i % 3 else float(v[i]) for k, v in enumerate(columns.values())) for i in range(3000)]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` double" for n in columns)).withColumn("none", F.lit(None).cast("double"))
    probs = [0.0, 0.2, 0.5, 0.99, 1.0]
    for accuracy in (10_000, 50):  # coarse cuts leave brackets to sort
        found = O.wide_quantiles(df, {n: F.col(f"`{n}`") for n in df.columns}, probs, accuracy).collect()
        got = {r["name"]: (r["n"], r["quantiles"]) for r in found}
        assert set(got) == set(columns)
        for k, n in enumerate(columns):
            x = np.array([r[k] for r in rows if r[k] is not None])
            assert got[n][0] == len(x) and got[n][1] == pytest.approx(list(np.quantile(x, probs)))


def test_slots_count_values_between_and_on_edges(spark):
    rows = [(1.0, None), (2.0, None), (2.0, 5.0), (2.5, float("nan")), (None, -1.0), (float("inf"), 0.0)]
    df = spark.createDataFrame(rows, "a double, b double").repartition(3)
    assert O.slot_counts(df, [[2.0, 3.0], [0.0]]) == [[1, 2, 1, 0, 1], [1, 1, 2]]
    assert O.slot_counts(df.where("false"), [[2.0], []]) == [[0, 0, 0], [0]]
