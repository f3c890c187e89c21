import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallywright.operators import anomaly, forest, trees
from tallywright.operators.quantile import exact_quantiles

from .test_register_and_reports import recon_table


def amounts(spark, values):
    return spark.createDataFrame([(None if v is None else str(v),) for v in values], "x string").select(
        F.col("x").cast("decimal(18,2)").alias("x")
    )


@pytest.mark.parametrize("seed", range(4))
def test_exact_quantiles(spark, seed):
    rnd = random.Random(seed)
    values = [round(rnd.choice([rnd.uniform(-50, 50), rnd.gauss(0, 1e7), 0]), 2) for _ in range(rnd.randint(1, 400))]
    values += [9999999999999.99, -9999999999999.99] * (seed % 2)
    ps = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = exact_quantiles(amounts(spark, [*values, None]), "x", ps).first()
    assert list(got) == pytest.approx(list(np.quantile(values, ps)), rel=1e-12, abs=1e-9)


def test_quantiles_of_nothing(spark):
    assert list(exact_quantiles(amounts(spark, []), "x", [0.25]).collect()[0]) == [None]


def z_and_iqr(spark, values):
    df = amounts(spark, values)
    got = df.select(
        "x", anomaly.z_score(df, "x").alias("z"), anomaly.iqr_flag(df, "x").alias("f")
    ).collect()
    return [(float(r.x), r.z, r.f) for r in got]


def test_no_spread_no_anomaly(spark):
    assert z_and_iqr(spark, [5]) == [(5.0, 0.0, False)]
    assert set(z_and_iqr(spark, [5, 5, 5])) == {(5.0, 0.0, False)}


def test_z_uses_the_sample_deviation_and_iqr_is_strict(spark):
    values = [0, 0, 4, 4, 10, 10.01, -6, -6.01]
    got = z_and_iqr(spark, values)
    s = pd.Series(values)
    want = dict(zip(values, (s - s.mean()) / s.std()))
    assert all(z == pytest.approx(want[x]) for x, z, _ in got)
    # quartiles of 0..4 repeated: the bounds are -6 and 10, which are not outside
    exact = [0, 0, 0, 4, 4, 4, 2, 10, -6]
    assert not any(f for _, _, f in z_and_iqr(spark, exact))
    assert [x for x, _, f in z_and_iqr(spark, [*exact[:-2], 10.01, -6]) if f] == [10.01]


@pytest.mark.parametrize("parts", [1, 200])
def test_a_value_at_the_bound_is_flagged_under_any_partitioning(spark, parts):
    # two values 30 cents from a mean of 100.10, whose sample deviation is 10 cents
    df = amounts(spark, [100.1] * 17 + [100.4, 99.8]).repartition(parts).cache()
    got = df.select("x", anomaly.z_score(df, "x").alias("z")).collect()
    assert sorted(r.z for r in got if r.z) == [-3.0, 3.0]


def test_scaling(spark):
    df = amounts(spark, [1, 2, 3, 6]).withColumn("c", F.lit(7))
    got = anomaly.standard_scale(df, ["x", "c"]).toPandas()
    assert got["x_scaled"].mean() == pytest.approx(0)
    assert got["x_scaled"].std(ddof=0) == pytest.approx(1)
    assert set(got["c_scaled"]) == {0.0}


def test_priorities_and_overwritten_nulls(spark):
    rows = [(str(i), "MATCHED", "0", None) for i in range(50)]
    rows += [("big", "MATCHED", "0", None), ("odd", "DUPLICATE", None, None)]
    recon = recon_table(spark, rows).withColumn(
        "erp_amount",
        F.when(F.col("transaction_id").isin("big"), F.lit(100000)).otherwise(F.lit(10)).cast("decimal(18,2)"),
    )
    got = {r.transaction_id: r for r in anomaly.detect_anomalies(recon, forest=False).collect()}
    assert got["big"].investigation_priority == "MEDIUM" and got["big"].amount_z_anomaly
    assert got["odd"].investigation_priority == "EXCEPTION_REVIEW"
    assert got["1"].investigation_priority == "NORMAL"
    assert got["odd"].payment_difference == 0 and got["1"].bank_difference == 0
    assert got["big"].isolation_forest_score is None


# --- isolation forest ----------------------------------------------------------------------------


def points(spark, n, outliers=0):
    rnd = np.random.default_rng(5)
    x = rnd.normal(0, 1, (n, 2))
    x[:outliers] = 40 + rnd.normal(0, 1, (outliers, 2))
    rows = [(0, i, float(a), float(b), 1.0) for i, (a, b) in enumerate(x)]
    return spark.createDataFrame(rows, "src_branch int, src_row long, a double, b double, c double")


FEATURES, ROW = ["a", "b", "c"], ["src_branch", "src_row"]


def scores(df, model):
    return {r.src_row: r.s for r in model.score(df, "s").select("src_row", "s").collect()}


@pytest.mark.parametrize("n", [300, 3000])
def test_outliers_are_flagged(spark, n):
    df = points(spark, n, outliers=5).cache()
    model = forest.fit_forest(df, FEATURES, ROW, trees=50)
    got = scores(df, model)
    assert len(got) == n and all(-0.5 <= s <= 0.5 for s in got.values())
    assert set(sorted(got, key=got.get)[:5]) == {0, 1, 2, 3, 4}
    assert all(got[i] < 0 for i in range(5))
    assert sum(s < 0 for s in got.values()) < n / 2


def test_same_seed_same_forest_under_any_partitioning(spark, partitions):
    df = points(spark, 2000)
    runs = []
    for shuffle, parts in ((1, 1), (13, 7)):
        partitions(shuffle)
        again = df.repartition(parts, "a").cache()
        runs.append(scores(again, forest.fit_forest(again, FEATURES, ROW, trees=20)))
    assert runs[0] == runs[1]


@pytest.mark.parametrize("rows", [100, 1500, 200_000])
def test_samples(spark, rows):
    df = spark.range(rows).selectExpr("0 AS src_branch", "id AS src_row").cache()
    drawn = forest.draw_samples(df, ROW, rows, 20, 42).cache()
    sizes = {r.tree: r["count"] for r in drawn.groupBy("tree").count().collect()}
    assert sizes == dict.fromkeys(range(20), min(rows, 256))
    assert drawn.distinct().count() == drawn.count()


@pytest.mark.parametrize("rows", [300, 1024, 2000])
def test_one_row_more_moves_few_flags(spark, rows, monkeypatch):
    monkeypatch.setattr(forest, "POOL", 1024)
    flags = []
    for n in (rows, rows + 1):
        df = points(spark, rows + 1).where(f"src_row < {n}").cache()
        got = scores(df, forest.fit_forest(df, FEATURES, ROW, trees=100))
        flags.append({i for i, s in got.items() if s < 0 and i < rows})
    assert len(flags[0] ^ flags[1]) <= 0.05 * rows


def test_path_length():
    assert [trees.mean_path(n) for n in (0, 1, 2)] == [0.0, 0.0, 1.0]
    assert trees.mean_path(256) == pytest.approx(10.2448, abs=1e-4)


def test_leaves_share_out_the_sample():
    x = np.random.default_rng(1).normal(size=(256, 3))
    nodes = trees.grow_tree(0, x, 42)
    leaves = nodes[nodes["low"] == nodes["node"]]
    assert len(nodes) == 2 * len(leaves) - 1 <= 511
    # a pure leaf holds its depth, at most the height limit of 8
    assert leaves["depth"].min() >= 1
    same = trees.grow_tree(0, x, 42)
    pd.testing.assert_frame_equal(nodes, same)


@pytest.mark.parametrize("rows", [0, 1, 2])
@pytest.mark.parametrize("with_forest", [True, False])
def test_tables_of_hardly_any_rows(spark, rows, with_forest):
    recon = recon_table(spark, [(str(i), "MATCHED", "0", None) for i in range(2)]).limit(rows)
    got = anomaly.detect_anomalies(recon, forest=with_forest)
    assert got.count() == rows
    assert got.where("amount_z_anomaly OR amount_iqr_anomaly").count() == 0
