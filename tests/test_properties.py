"""Property-based checks of the distributed paths against Spark's built-in
forms on random inputs (keys, ties, NULL order keys and NULL values)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vireo.operators import aggregate as agg
from vireo.operators.window import running_sum, running_sum_window

ROWS = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", None]),
              st.one_of(st.none(), st.integers(-5, 30)),
              st.one_of(st.none(), st.integers(-100, 100))),
    min_size=0, max_size=60)

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _df(spark, rows):
    data = [(i, k, o, v) for i, (k, o, v) in enumerate(rows)]
    return spark.createDataFrame(data, "id long, k string, o int, v long")


@SETTINGS
@given(rows=ROWS, parts=st.integers(1, 7), desc=st.booleans(), keyed=st.booleans())
def test_running_sum_equals_window(spark, rows, parts, desc, keyed):
    df = _df(spark, rows)
    keys = ["k"] if keyed else []
    a = running_sum(df, "v", "o", "cum", partition_by=keys, descending=desc, num_partitions=parts)
    b = running_sum_window(df, "v", "o", "cum", partition_by=keys, descending=desc)
    assert sorted(((r.id, r.cum) for r in a.collect()), key=repr) == \
        sorted(((r.id, r.cum) for r in b.collect()), key=repr)


@SETTINGS
@given(rows=ROWS, p=st.sampled_from([0.0, 0.1, 0.5, 0.9, 1.0]))
def test_exact_quantile_equals_percentile(spark, rows, p):
    df = _df(spark, rows).where(F.col("k").isNotNull())
    ours = {r.k: r.q for r in agg.exact_quantiles(df, "v", [p], partition_by=["k"], names=["q"]).collect()}
    ref = {r.k: r.q for r in df.groupBy("k").agg(F.percentile("v", p).alias("q")).collect()}
    assert set(ours) == set(ref)
    for k in ref:
        if ref[k] is None or ours[k] is None:
            assert ref[k] is None and ours[k] is None
        else:
            assert abs(ours[k] - ref[k]) <= 1e-9 * max(1.0, abs(ref[k]))


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", None]),
                               st.one_of(st.none(), st.integers(0, 240)),      # minutes; ties likely
                               st.integers(0, 50)), min_size=0, max_size=60),
       parts=st.integers(1, 6), gap=st.sampled_from([5, 10, 30]))
def test_sessions_equal_session_window(spark, rows, parts, gap):
    import datetime as dt
    from vireo.operators.sessions import sessions
    from vireo.streaming.windows import session_summary
    base = dt.datetime(2024, 1, 1)
    data = [(k, None if m is None else base + dt.timedelta(minutes=m), float(v)) for k, m, v in rows]
    df = spark.createDataFrame(data, "k string, ts timestamp, value double")
    g = f"{gap} minutes"
    a = sessions(df, "ts", g, ["k"], "value", num_partitions=parts)
    b = session_summary(df, "ts", g, ["k"], "value")
    assert sorted((tuple(r) for r in a.collect()), key=repr) == sorted((tuple(r) for r in b.collect()), key=repr)


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-50, 50))),
                     min_size=0, max_size=60),
       parts=st.integers(1, 7), keyed=st.booleans(), desc=st.booleans())
def test_unique_order_running_sum_equals_window(spark, rows, parts, keyed, desc):
    data = [(i, k, v) for i, (k, v) in enumerate(rows)]          # id is unique
    df = spark.createDataFrame(data, "id long, k string, v long")
    keys = ["k"] if keyed else []
    a = running_sum(df, "v", "id", "cum", partition_by=keys, descending=desc, num_partitions=parts,
                    unique_order=True)
    b = running_sum_window(df, "v", "id", "cum", partition_by=keys, descending=desc)
    assert sorted(((r.id, r.k, r.v, r.cum) for r in a.collect()), key=repr) == \
        sorted(((r.id, r.k, r.v, r.cum) for r in b.collect()), key=repr)
