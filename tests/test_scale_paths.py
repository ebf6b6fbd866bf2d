"""Invariants of the distributed paths against Spark's built-in (single
task / single buffer) forms, on data with ties, NULLs and a hot key."""

import random

import pytest
from pyspark.sql import functions as F

from vireo.operators import aggregate as agg
from vireo.operators import project
from vireo.operators.window import running_sum, running_sum_window


def _data(spark, n=3000, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = "hot" if rnd.random() < 0.34 else f"k{rnd.randrange(20)}"
        o = None if rnd.random() < 0.02 else rnd.randrange(200)   # ties and NULL order keys
        rows.append((i, k, o, rnd.randrange(-50, 100)))
    return spark.createDataFrame(rows, "id long, k string, o int, v long")


@pytest.mark.parametrize("desc", [False, True])
def test_running_sum_global_matches_window(spark, desc):
    df = _data(spark)
    a = running_sum(df, "v", "o", "cum", descending=desc, num_partitions=7)
    b = running_sum_window(df, "v", "o", "cum", descending=desc)
    ra = sorted((r.id, r.cum) for r in a.collect())
    rb = sorted((r.id, r.cum) for r in b.collect())
    assert ra == rb


def test_running_sum_partitioned_matches_window(spark):
    df = _data(spark, seed=2)
    a = running_sum(df, "v", "o", "cum", partition_by=["k"], num_partitions=9)
    b = running_sum_window(df, "v", "o", "cum", partition_by=["k"])
    assert sorted((r.id, r.cum) for r in a.collect()) == sorted((r.id, r.cum) for r in b.collect())


def test_running_sum_decimal_exact(spark):
    df = _data(spark, seed=3).withColumn("m", (F.col("v") / 7).cast("decimal(18,2)"))
    a = running_sum(df, "m", "o", "cum", num_partitions=5)
    b = running_sum_window(df, "m", "o", "cum")
    assert sorted((r.id, r.cum) for r in a.collect()) == sorted((r.id, r.cum) for r in b.collect())


def test_running_sum_plan_has_no_single_partition_data_exchange(spark):
    import re
    df = spark.range(0, 100000).select((F.col("id") % 977).alias("o"), F.lit(1).alias("v"))
    plan = running_sum(df, "v", "o", "cum")._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" in plan                      # reads the checkpointed, range-partitioned scan
    specs = re.findall(r"windowspecdefinition\(([^)]*)", plan)
    assert specs and all("__vireo_pid" in sp for sp in specs)   # the only window: n-row offsets


def test_exact_quantiles_match_percentile(spark):
    df = _data(spark, seed=4)
    probs = [0.1, 0.25, 0.5, 0.9]
    ours = agg.exact_quantiles(df, "v", probs, partition_by=["k"]).collect()
    ref = df.groupBy("k").agg(*[F.percentile("v", p).alias(f"p{int(p * 100)}") for p in probs]).collect()
    a = {r.k: tuple(round(r[f"p{int(p * 100)}"], 9) for p in probs) for r in ours}
    b = {r.k: tuple(round(r[f"p{int(p * 100)}"], 9) for p in probs) for r in ref}
    assert a == b


def test_dense_index_and_zip(spark):
    a = spark.range(0, 500).select((F.col("id") * 3).alias("x"))
    b = spark.range(0, 500).select((F.col("id") * 5 + 1).alias("y"))
    z = project.zip_positional(a, "x", b, "y", ["x"], ["y"]).collect()
    assert all(r.y == (r.x // 3) * 5 + 1 for r in z) and len(z) == 500
    with pytest.raises(Exception):
        project.zip_positional(a, "x", b.where("y > 10"), "y", ["x"], ["y"]).collect()


def test_salted_sum_spreads_hot_key(spark):
    df = _data(spark, seed=5)
    hot = spark.createDataFrame([("hot",)], "k string")
    out = agg.salted_sum(df, "k", "v", salts=8, hot=hot, salt_by=["id"])
    direct = df.groupBy("k").agg(F.sum("v").alias("total"))
    assert sorted(out.collect()) == sorted(direct.collect())
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" in plan


def test_histogram_last_bucket_closed(spark):
    df = spark.range(0, 101).select(F.col("id").cast("double").alias("x"))
    h = {r.bucket: r["count"] for r in agg.histogram(df, "x", 10).collect()}
    assert h[9] == 11 and sum(h.values()) == 101 and len(h) == 10


def test_impute_mean_truncates_integers(spark):
    df = spark.createDataFrame([(1, 4.0), (None, None), (8, 5.0)], "a int, b double")
    out = project.impute_mean(df).collect()
    assert sorted((r.a, r.b) for r in out) == [(1, 4.0), (4, 4.5), (8, 5.0)]


def test_parquet_scan_prunes_and_pushes(spark):
    from conftest import SF_SMALL
    from vireo.sources.tables import table
    df = table(spark, SF_SMALL, "customer").where("c_acctbal >= 1000").select("c_custkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(c_acctbal), GreaterThanOrEqual(c_acctbal,1000.0)]" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double>" in plan


@pytest.mark.parametrize("gap", ["10 minutes", "2 hours"])
def test_distributed_sessions_match_session_window(spark, gap):
    import datetime as dt
    from vireo.operators.sessions import sessions
    from vireo.streaming.windows import session_summary
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    rows = [(0 if rnd.random() < 0.4 else rnd.randrange(50),          # user 0 holds 40 %
             base + dt.timedelta(seconds=rnd.randrange(0, 86400 * 3)), float(rnd.randrange(100)))
            for _ in range(8000)]
    rows += [(0, base + dt.timedelta(seconds=5), 1.0)] * 20           # identical events
    rows += [(7, base, 1.0), (7, base + dt.timedelta(minutes=10), 1.0)]  # exactly one gap apart
    df = spark.createDataFrame(rows, "user_id long, ts timestamp, value double")
    a = sessions(df, "ts", gap, ["user_id"], "value", num_partitions=17)
    b = session_summary(df, "ts", gap, ["user_id"], "value")
    assert sorted(tuple(r) for r in a.collect()) == sorted(tuple(r) for r in b.collect())


def test_running_sum_null_values_and_empty_input(spark):
    rows = [(1, "a", 1, None), (2, "a", 2, None), (3, "a", 3, 5), (4, "b", 1, None), (5, "b", 1, 2),
            (6, "b", 4, None), (7, "c", 1, None)]
    df = spark.createDataFrame(rows, "id long, k string, o int, v long")
    for keys in ([], ["k"]):
        a = running_sum(df, "v", "o", "cum", partition_by=keys, num_partitions=3)
        b = running_sum_window(df, "v", "o", "cum", partition_by=keys)
        assert sorted((r.id, r.cum) for r in a.collect()) == sorted((r.id, r.cum) for r in b.collect())
    dm = df.withColumn("v", F.col("v").cast("decimal(10,2)"))
    a = running_sum(dm, "v", "o", "cum", partition_by=["k"], num_partitions=2)
    b = running_sum_window(dm, "v", "o", "cum", partition_by=["k"])
    assert sorted((r.id, r.cum) for r in a.collect()) == sorted((r.id, r.cum) for r in b.collect())
    assert running_sum(df.where("id < 0"), "v", "o", "cum").count() == 0


def test_running_sum_nan_propagates_like_sql(spark):
    rows = [(1, 1, 1.0), (2, 2, float("nan")), (3, 3, 2.0), (4, 1, None)]
    df = spark.createDataFrame(rows, "id long, o int, v double")
    a = running_sum(df, "v", "o", "cum", num_partitions=2)
    b = running_sum_window(df, "v", "o", "cum")
    norm = lambda rs: sorted((r.id, "nan" if r.cum != r.cum else r.cum) for r in rs)
    assert norm(a.collect()) == norm(b.collect())


def test_token_counts_read_only_the_text(spark):
    from vireo.functions.text import token_counts
    from vireo.sources.tables import table
    df = token_counts(table(spark, "/root/testdata/sf0.001", "documents"), "text")
    assert "ReadSchema: struct<text:string>" in df._jdf.queryExecution().executedPlan().toString()


def test_running_sum_of_large_decimals_equals_the_window(spark):
    from decimal import Decimal
    rows = [(i, i % 3, Decimal(5 * 10 ** 18) + Decimal(i) / 100) for i in range(40)] + [(99, None, None)]
    for kind in ("decimal(24,2)", "decimal(38,6)"):
        df = spark.createDataFrame(rows, "id int, k int, v decimal(24,2)").withColumn("v", F.col("v").cast(kind))
        for keys in ([], ["k"]):
            a = running_sum(df, "v", "v", "cum", keys, num_partitions=4, total="all")
            b = running_sum_window(df, "v", "v", "cum", keys)
            assert a.schema["cum"].dataType == b.schema["cum"].dataType
            assert sorted(map(repr, a.select("id", "cum").collect())) == sorted(map(repr, b.select("id", "cum").collect()))
            whole = df.groupBy(*keys).agg(F.sum("v").alias("t")).collect()
            assert {r["all"] for r in a.collect()} == {r.t for r in whole}


def test_distributed_paths_do_not_rely_on_exchange_reuse(spark):
    # range boundaries are sampled per exchange; with reuse off every branch
    # plans its own exchange, so consistency must come from the checkpoint
    from vireo.operators.sessions import sessions
    from vireo.streaming.windows import session_summary
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        df = _data(spark, n=4000, seed=11).withColumn("name", F.concat(F.lit("n"), F.col("id").cast("string")))
        ordered = df.select("name", F.struct("o", "id").alias("ord"))
        idx = project.dense_index(ordered, "ord", "idx")
        r = idx.agg(F.countDistinct("idx").alias("d"), F.max("idx").alias("m")).first()
        assert (r.d, r.m) == (4000, 4000)
        a = running_sum(df, "v", "o", "cum", partition_by=["k"], num_partitions=9)
        b = running_sum_window(df, "v", "o", "cum", partition_by=["k"])
        assert sorted((x.id, x.cum) for x in a.collect()) == sorted((x.id, x.cum) for x in b.collect())
        ev = df.select("k", (F.lit(1_700_000_000) + F.col("id") * 97).cast("timestamp").alias("ts"), "v")
        s1 = sessions(ev, "ts", "2 minutes", ["k"], num_partitions=7)
        s2 = session_summary(ev, "ts", "2 minutes", ["k"])
        assert sorted(map(tuple, s1.collect()), key=repr) == sorted(map(tuple, s2.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")


def test_checkpoints_go_when_their_result_is_released(spark):
    import gc
    import time
    from pathlib import Path
    from urllib.parse import urlparse
    from vireo.session import checkpoint_dir
    folder = Path(urlparse(checkpoint_dir(spark)).path)
    rdds = lambda: {p.name for p in folder.glob("**/rdd-*")}
    before = rdds()
    out = running_sum(_data(spark, n=500, seed=3), "v", "o", "cum", num_partitions=3)
    assert out.count() == 500 and rdds() - before
    del out
    for _ in range(30):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)
        if not rdds() - before:
            break
    assert not rdds() - before


@pytest.mark.parametrize("keyed", [False, True])
def test_decimal_prefix_sums_equal_python(keyed):
    """Limb sums are exact with signs, carries over 64 bits, batch borders and slices."""
    from decimal import Context, Decimal, localcontext

    import pyarrow as pa

    from vireo.operators import window

    rng = random.Random(4)
    kind = pa.decimal128(38, 4)
    rows = [(i // 17 if keyed else 0, Decimal(rng.randint(-10**e, 10**e)).scaleb(-4, Context(prec=76))) for i, e in enumerate(rng.choices([1, 9, 19, 30, 36], k=200))]
    batch = pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows]), pa.array([v for _, v in rows], kind), pa.array([1] * len(rows), pa.int64())], ["k", window._TIE, window._NN])
    batches = [batch.slice(a, n) for a, n in ((0, 50), (50, 0), (50, 1), (51, 149))]
    got = [x for b in window._local_prefix(["k"] if keyed else [])(iter(batches)) for x in b.column(window._LOC).to_pylist()]
    want, sums = [], {}
    with localcontext(Context(prec=76)):
        for k, v in rows:
            sums[k] = sums.get(k, Decimal(0)) + v
            want.append(sums[k])
    assert got == want


def test_decimal_prefix_sums_beyond_38_digits_fail():
    import pyarrow as pa

    from vireo.operators import window
    from decimal import Decimal

    def run(values):
        batch = pa.RecordBatch.from_arrays([pa.array([Decimal(v) for v in values], pa.decimal128(38, 0)), pa.array([1] * len(values), pa.int64())], [window._TIE, window._NN])
        return [x for b in window._local_prefix([])(iter([batch])) for x in b.column(window._LOC).to_pylist()]

    most = 10**38 - 1
    assert run([most - 1, 1, -most, -most]) == [most - 1, most, 0, -most]
    with pytest.raises(ArithmeticError):
        run([most, 1])
