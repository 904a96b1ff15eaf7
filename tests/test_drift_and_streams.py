import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from truegrain.operators import detect, drift, forecast, windows
from truegrain.operators.joins import seasonal_windows
from truegrain.streaming import events as E


def test_psi_by_hand(spark):
    rows = [("a", True)] * 3 + [("b", True)] + [("a", False)] * 2 + [("c", False)] * 2
    df = spark.createDataFrame(rows, "c string, ref boolean")
    p = {"a": 0.75, "b": 0.25, "c": 0.0}
    q = {"a": 0.5, "b": 0.0, "c": 0.5}
    want = sum((q[k] - p[k]) * math.log((q[k] + 1e-4) / (p[k] + 1e-4)) for k in p)
    assert drift.psi(df, [], "c", F.col("ref")).first().psi == pytest.approx(want)


@pytest.mark.parametrize("t, df, p", [(2.0, 10, 0.0733880), (1.0, 1, 0.5), (12.7062, 1, 0.05), (1.959964, 1e7, 0.05), (0.0, 5, 1.0)])
def test_p_values(t, df, p):
    assert drift.student_t_p(t, df) == pytest.approx(p, rel=1e-4)


def test_seasonal_windows_by_brute_force(spark):
    days = [dt.date(2023, 11, 1) + dt.timedelta(days=i) for i in range(0, 460)]
    df = spark.createDataFrame([(d,) for d in days], "day date")
    got = {(r.week, r.is_reference, r.day) for r in seasonal_windows(df, "day", "2025-01-06", "2025-01-27").collect()}
    want = set()
    for k in range(4):
        week = dt.date(2025, 1, 6) + dt.timedelta(days=7 * k)
        for d in days:
            if week <= d <= week + dt.timedelta(days=6):
                want.add((week, False, d))
            if week - dt.timedelta(days=378) <= d <= week - dt.timedelta(days=344):
                want.add((week, True, d))
    assert got == want


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(4)
    rows = []
    for k in range(4):
        level = np.where(np.arange(200) < 90, 0.0, 2.0 if k % 2 else -1.5)
        for i, x in enumerate(rng.normal(0, 1, 200) + level):
            rows.append((k, dt.date(2025, 1, 1) + dt.timedelta(days=i), float(x)))
    return rows, spark.createDataFrame(rows, "k bigint, day date, x double")


def test_first_alarm_closed_form_equals_the_sequential_test(series):
    _, df = series
    first = {r.k: r.first_alarm for r in drift.first_page_hinkley(df, ["k"], "day", "x", 14, 0.5, 15.0).collect()}
    alarms = drift.page_hinkley(df, ["k"], "day", "x", 14, 0.5, 15.0, alpha=1.0)
    assert first == {r.k: r.d for r in alarms.groupBy("k").agg(F.min("day").alias("d")).collect()} and len(first) == 4


def test_cusum_equals_the_loop(series):
    rows, df = series
    out = windows.cusum(df.withColumnRenamed("x", "z"), ["k"], "day").filter("k = 1").orderBy("day").collect()
    zs = [x for k, _, x in rows if k == 1]
    c = [0.0]
    for z in zs[1:]:
        c.append(max(0.0, c[-1] + z - 0.5))
    assert np.allclose([r.cusum for r in out], c)


def test_stream_detector_equals_batch_over_several_files(series, spark, tmp_path):
    _, df = series
    folder = str(tmp_path / "in")
    for i, (lo, hi) in enumerate([("2025-01-01", "2025-03-01"), ("2025-03-01", "2025-05-01"), ("2025-05-01", "2026-01-01")]):
        part = df.filter(F.col("day").between(F.lit(lo).cast("date"), F.date_sub(F.lit(hi).cast("date"), 1)))
        part.coalesce(1).write.mode("append").parquet(f"{folder}/part={i}")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(folder)
    out = E.page_hinkley_stream(stream, "k", "day", "x", 14, 0.5, 15.0)
    got = sorted((r.k, r.day) for r in E.read_back(spark, E.run_to_files(out, "ph", folder=str(tmp_path / "out")), out.schema).collect())
    want = sorted((r.k, r.day) for r in drift.page_hinkley(df, ["k"], "day", "x", 14, 0.5, 15.0).collect())
    assert got == want and want


def test_dedupe_across_micro_batches(spark, tmp_path):
    folder = str(tmp_path / "in")
    stamp = lambda m: dt.datetime(2025, 1, 1, 8) + dt.timedelta(minutes=m)
    schema = "event_id bigint, ts timestamp"
    spark.createDataFrame([(1, stamp(0)), (2, stamp(1)), (1, stamp(2))], schema).coalesce(1).write.parquet(f"{folder}/a")
    spark.createDataFrame([(2, stamp(3)), (3, stamp(4))], schema).coalesce(1).write.parquet(f"{folder}/b")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(folder)
    out = E.dedupe_resent(stream, "event_id", "ts")
    ids = [r.event_id for r in E.read_back(spark, E.run_to_files(out, "dd", folder=str(tmp_path / "out")), out.schema).collect()]
    assert sorted(ids) == [1, 2, 3]


def test_routes_keep_every_row(spark, tmp_path):
    folder = str(tmp_path / "in")
    spark.range(100).write.parquet(folder)
    stream = spark.readStream.schema("id bigint").parquet(folder)
    paths = E.run_routed(stream, "r", {"low": F.col("id") < 10, "even": F.col("id") % 2 == 0}, folder=str(tmp_path / "out"))
    sizes = {k: E.read_back(spark, p, stream.schema).count() for k, p in paths.items()}
    assert sizes == {"low": 10, "even": 45, "unrouted": 45}


def test_clock_repair(spark):
    base = dt.datetime(2025, 1, 1, 8)
    rows = [(t, base + dt.timedelta(hours=4 if t == 1 else 0, minutes=i), base + dt.timedelta(minutes=i, seconds=5)) for t in (1, 2) for i in range(20)]
    df = spark.createDataFrame(rows, "t int, event_time timestamp_ntz, at timestamp_ntz")
    skew = E.clock_skew(df, ["t"], "event_time", "at")
    assert {r.t: r.skewed for r in skew.collect()} == {1: True, 2: False}
    assert E.repair_clock(df, skew, ["t"], "event_time").filter(F.col("event_time") > F.col("at")).count() == 0


def test_ecod_by_brute_force(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"id": np.arange(300), "a": np.round(rng.exponential(1, 300), 1), "b": np.round(rng.normal(0, 1, 300), 1)})
    out = detect.ecod(spark.createDataFrame(pdf), ["a", "b"]).orderBy("id").toPandas()
    total = np.zeros((3, 300))
    for c in ("a", "b"):
        x = pdf[c].to_numpy()
        left = -np.log([(x <= v).mean() for v in x])
        right = -np.log([(x >= v).mean() for v in x])
        skew = ((x - x.mean()) ** 3).mean() / x.std() ** 3
        total += np.stack([left, right, left if skew < 0 else right])
    assert np.allclose(out.ecod, total.max(axis=0))


@pytest.mark.parametrize("chunk", [40, 10_000])
def test_lof_by_brute_force(spark, chunk):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"id": np.arange(250), "x": rng.normal(0, 1, 250)})
    out = detect.lof(spark.createDataFrame(pdf), "id", "x", k=5, chunk=chunk).toPandas().set_index("id").lof.sort_index()
    x = pdf.x.to_numpy()
    gaps = np.abs(x[:, None] - x)
    np.fill_diagonal(gaps, np.inf)
    near = np.argsort(gaps, axis=1, kind="stable")[:, :5]
    dist = np.take_along_axis(gaps, near, axis=1)
    density = 1 / (np.maximum(dist[:, -1][near], dist).mean(axis=1) + 1e-10)
    assert len(out) == 250 and np.allclose(out, density[near].mean(axis=1) / density)


def test_isolation_forest_ranks_the_outlier_first(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"id": np.arange(1000), "a": rng.normal(0, 1, 1000), "b": rng.normal(0, 1, 1000)})
    pdf.loc[7, ["a", "b"]] = 9.0
    df = spark.createDataFrame(pdf)
    out = detect.isolation_forest(df, "id", ["a", "b"], trees=40).orderBy(F.desc("isolation")).first()
    again = detect.isolation_forest(df.repartition(5), "id", ["a", "b"], trees=40).orderBy(F.desc("isolation")).first()
    assert out.id == 7 and again.isolation == pytest.approx(out.isolation)


def test_grouped_least_squares(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 300), "a": rng.normal(size=300), "b": rng.normal(size=300)})
    pdf["y"] = 1 + 2 * pdf.a - pdf.g * pdf.b + rng.normal(0, 0.1, 300)
    out = forecast.grouped_least_squares(spark.createDataFrame(pdf), ["g"], ["a", "b"], "y").collect()
    for r in out:
        part = pdf[pdf.g == r.g]
        m = np.column_stack([np.ones(len(part)), part.a, part.b])
        assert np.allclose(r.beta, np.linalg.lstsq(m, part.y, rcond=None)[0])


def test_backtest_policies(spark):
    days = pd.date_range("2024-01-01", "2025-03-31")
    rows = [(d.date(), s, float(20 + 5 * s + (60 if d >= pd.Timestamp("2025-01-20") else 0)), 0.0) for d in days for s in (1, 2)]
    df = spark.createDataFrame(rows, "date date, store bigint, quantity double, promo double")
    spec = forecast.ForecastSpec("date", "quantity", ("store",), ("promo",), learner="linear")
    start, end = dt.date(2025, 1, 1), dt.date(2025, 3, 31)
    wape = {}
    for when in ("never", "monthly", "alarm"):
        out, retrains = forecast.backtest(df, spec, start, end, when, 10, detector=drift.PageHinkley(7, 0.02, 0.5))
        assert out.count() == 180
        late = out.filter(F.col("date") >= F.lit("2025-03-15").cast("date"))
        wape[when] = late.agg(F.sum(F.abs(F.col("pred") - F.col("quantity"))) / F.sum("quantity")).first()[0]
        assert len(retrains) == {"never": 0, "monthly": 2}.get(when, len(retrains)) and (when != "alarm" or retrains)
    assert wape["monthly"] < 0.05 and wape["alarm"] < wape["never"]


def test_measurement_error_is_reproducible(spark):
    df = spark.range(5000).withColumn("x", F.lit(10.0))
    a = forecast.add_measurement_error(df, "x", 0.3, 0.2, "id", seed=1)
    b = forecast.add_measurement_error(df.repartition(6), "x", 0.3, 0.2, "id", seed=1)
    assert a.agg(F.sum("both")).first()[0] == pytest.approx(b.agg(F.sum("both")).first()[0])
    stats = a.agg(F.avg("imprecise"), F.stddev("imprecise"), F.avg("inaccurate")).first()
    assert stats[0] == pytest.approx(10, abs=0.2) and stats[1] == pytest.approx(3, abs=0.2) and stats[2] == pytest.approx(8)


def test_latest_windows_over_several_batches(spark, tmp_path):
    """Windows that later micro-batches add to, and those still open at the end, have their last value once."""
    day = dt.datetime(2024, 1, 1)
    for part in range(3):
        rows = [(day + dt.timedelta(hours=6 * i + part), 1.0 + part) for i in range(8)]
        spark.createDataFrame(rows, "ts timestamp, value double").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp, value double").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = E.windowed_metrics(stream, "ts", {"n": F.count(F.lit(1)), "total": F.sum("value")}, delay="10 days")
    got = E.run_latest(out, "latest", ["window_start"], folder=str(tmp_path / "out")).orderBy("window_start").collect()
    assert [(r.n, r.total) for r in got] == [(12, 24.0), (12, 24.0)]


def plain_lof(x, k):
    """All pairs; the neighbourhood has all rows as far as the k-th nearest."""
    gaps = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    np.fill_diagonal(gaps, np.inf)
    k = min(k, len(x) - 1)
    if k < 1:
        return np.ones(len(x))
    kth = np.sort(gaps, axis=1)[:, k - 1]
    near = gaps <= kth[:, None]
    reach = np.where(near, np.maximum(kth[None, :], np.where(near, gaps, 0)), 0)
    density = 1 / (reach.sum(axis=1) / near.sum(axis=1) + 1e-10)
    return (near * density[None, :]).sum(axis=1) / near.sum(axis=1) / density


@pytest.mark.parametrize(("cell", "k"), [(64, 10), (64, 100), (4096, 100)])
def test_lof_of_three_features_by_brute_force(spark, cell, k):
    from truegrain.operators import density

    rng = np.random.default_rng(4)
    x = np.round(rng.normal(0, 1, (900, 3)), 1)
    x[:250, 0] = 0.0
    x[:130] = [0.0, 0.5, 1.0]
    x[-3:] = [[9, 9, 9], [-7, 0, 4], [1e3, -1e3, 0]]
    pdf = pd.DataFrame({"id": np.arange(900), "g": ["a/b"] * 600 + [None] * 298 + ["one"] * 2, "a": x[:, 0], "b": x[:, 1], "c": x[:, 2]})
    df = spark.createDataFrame(pdf).unionByName(spark.createDataFrame([(900, "a/b", None, 1.0, 1.0), (901, "a/b", float("nan"), 1.0, 1.0), (902, "alone", 1.0, 1.0, 1.0)], "id long, g string, a double, b double, c double"))
    out = density.lof(df, "id", ["a", "b", "c"], ["g"], k=k, cell=cell).toPandas().set_index("id").lof.sort_index()
    want = np.concatenate([plain_lof(x[s], k) for s in (slice(0, 600), slice(600, 898), slice(898, 900))])
    assert out.index.tolist() == [*range(900), 902] and out[902] == 1.0
    assert np.allclose(out.to_numpy()[:900], want, rtol=1e-6)


def test_lof_of_an_empty_table(spark):
    from truegrain.operators import density

    assert density.lof(spark.createDataFrame([], "id long, a double, b double"), "id", ["a", "b"]).count() == 0


def test_row_numbers_do_not_order_all_rows_in_one_task(spark):
    from truegrain.operators.detect import _row_numbers

    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")
    try:
        rows = spark.range(3000).withColumnRenamed("id", "row")
        out = _row_numbers(rows, "row", 3).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set(coalesce, before)
    assert sorted(r._number for r in out) == list(range(1, 3001))
    expected = [r.row for r in rows.orderBy(F.xxhash64(F.lit(3), "row")).collect()]
    assert [r.row for r in sorted(out, key=lambda r: r._number)] == expected
    assert len({r.task for r in out}) > 1


def test_detector_kernels_keep_their_values():
    from truegrain.operators.detect import _lof_line

    def plain(x, k):
        n = len(x)
        k = min(k, n - 1)
        near = []
        for i in range(n):
            others = [j for j in range(max(0, i - k), min(n, i + k + 1)) if j != i]
            near.append(sorted(others, key=lambda j: abs(x[j] - x[i]))[:k])
        reach = [abs(x[near[i][-1]] - x[i]) for i in range(n)]
        density = np.array([1 / (np.mean([max(reach[j], abs(x[j] - x[i])) for j in near[i]]) + 1e-10) for i in range(n)])
        return np.array([density[near[i]].mean() / density[i] for i in range(n)])

    rng = np.random.default_rng(5)
    for n, k in ((2, 5), (7, 3), (60, 10), (300, 40)):
        x = np.sort(np.round(rng.normal(size=n), 1))
        np.testing.assert_allclose(_lof_line(x, k), plain(x, k), rtol=1e-12)
