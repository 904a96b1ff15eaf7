import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from truegrain.operators import aggregates as A
from truegrain.operators import drift as X
from truegrain.operators import ranks as R
from truegrain.operators import sampling


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    n = 3000
    key = np.where(rng.random(n) < 0.6, "hot", rng.choice(list("abc"), n))
    value = np.round(rng.normal(10, 5, n), 1)
    pdf = pd.DataFrame({"id": np.arange(n), "key": key, "value": value, "ref": rng.random(n) < 0.5, "truth": rng.random(n) < 0.1})
    return pdf, spark.createDataFrame(pdf).cache()


@pytest.mark.parametrize("spread", [False, True])
def test_quantiles(table, spread):
    pdf, df = table
    out = R.quantiles(df, ["key"], "value", {"a": 0.1, "m": 0.5, "z": 0.93}, spread=spread).toPandas().set_index("key")
    want = pdf.groupby("key").value.quantile([0.1, 0.5, 0.93]).unstack()
    for name, p in (("a", 0.1), ("m", 0.5), ("z", 0.93)):
        assert np.allclose(out[name].sort_index(), want[p].sort_index())


@pytest.mark.parametrize("spread", [False, True])
def test_median_and_mad(table, spread):
    pdf, df = table
    out = R.median_and_mad(df, ["key"], "value", spread=spread).toPandas().set_index("key").sort_index()
    med = pdf.groupby("key").value.median()
    mad = (pdf.value - pdf.key.map(med)).abs().groupby(pdf.key).median()
    assert np.allclose(out["median"], med) and np.allclose(out["mad"], mad)


@pytest.mark.parametrize("inclusive", [True, False])
def test_running_forms_agree(table, inclusive):
    _, df = table
    counts = R.value_counts(df, ["key"], "value")
    aggs = {"s": ("sum", "n"), "top": ("max", "n"), "low": ("min", "n")}
    plain = R.running(counts, ["key"], "value", aggs, inclusive, True, spread=False).toPandas()
    bucketed = R.running(counts, ["key"], "value", aggs, inclusive, True, spread=True, buckets=16).toPandas()
    order = ["key", "value"]
    pd.testing.assert_frame_equal(
        plain.sort_values(order).reset_index(drop=True), bucketed.sort_values(order).reset_index(drop=True), check_dtype=False
    )


@pytest.mark.parametrize("spread", [False, True])
def test_ks_and_wasserstein(table, spread):
    pdf, df = table
    ks = R.ks_statistic(df, ["key"], "value", F.col("ref"), spread=spread).toPandas().set_index("key").ks
    ws = X.wasserstein(df, ["key"], "value", F.col("ref"), spread=spread).toPandas().set_index("key").distance
    for key, g in pdf.groupby("key"):
        a, b = np.sort(g.value[g.ref]), np.sort(g.value[~g.ref])
        grid = np.unique(g.value)
        fa, fb = (np.searchsorted(x, grid, side="right") / len(x) for x in (a, b))
        assert ks[key] == pytest.approx(np.abs(fa - fb).max())
        area = (np.abs(fa - fb)[:-1] * np.diff(grid)).sum()
        assert ws[key] == pytest.approx(area / a.std())


def test_detector_metrics_by_brute_force(table, monkeypatch):
    pdf, df = table
    for limit in (10**9, 100):
        monkeypatch.setattr(R.heavy, "__defaults__", (limit,))
        top = A.precision_at_k(df, ["key"], "value", "id", F.col("truth")).toPandas().set_index("key")
        ap = A.average_precision(df, ["key"], "value", F.col("truth")).toPandas().set_index("key")
        auc = A.roc_auc(df, ["key"], "value", F.col("truth")).toPandas().set_index("key")
        for key, g in pdf.groupby("key"):
            ranked = g.sort_values(["value", "id"], ascending=[False, True])
            k = int(g.truth.sum())
            assert top.k[key] == k and top.hits[key] == ranked.truth[:k].sum()
            pos, neg = g.value[g.truth].to_numpy(), g.value[~g.truth].to_numpy()
            wins = (pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()
            assert auc.auc[key] == pytest.approx(wins / len(pos) / len(neg))
            recall = total = 0.0
            for s in sorted(g.value.unique(), reverse=True):
                above = g[g.value >= s]
                new = above.truth.sum() / k
                total += (new - recall) * above.truth.mean()
                recall = new
            assert ap.average_precision[key] == pytest.approx(total)


def test_top_share(table):
    pdf, df = table
    got = {r.id for r in sampling.top_share(df, 0.05, "value", "id").select("id").collect()}
    want = set(pdf.sort_values(["value", "id"], ascending=[False, True]).id[: int(0.05 * len(pdf))])
    assert got == want


def test_hash_samples_do_not_depend_on_partitions(spark):
    ids = spark.range(20000)
    one = {r.id for r in sampling.sample_fraction(ids.coalesce(1), 0.1, "id", seed=2).collect()}
    many = {r.id for r in sampling.sample_fraction(ids.repartition(7), 0.1, "id", seed=2).collect()}
    assert one == many and 1700 < len(one) < 2300


@pytest.mark.parametrize("ids", ["row", "text"])
def test_running_over_text_ids_in_both_forms(spark, ids):
    name = (lambda i: f"row-{i * 7919 % 500:03d}") if ids == "row" else (lambda i: chr(97 + i % 26) + "é" * (i % 3) + str(i))
    df = spark.createDataFrame([("hot" if i % 3 else "b", name(i), i) for i in range(500)], "key string, id string, n int")
    plain = {tuple(r) for r in R.running(df, ["key"], "id", {"upto": ("sum", "n")}, totals=True, spread=False).collect()}
    assert {tuple(r) for r in R.running(df, ["key"], "id", {"upto": ("sum", "n")}, totals=True, spread=True, buckets=7).collect()} == plain
