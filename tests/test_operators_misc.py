"""Operators whose contract is not a SQL result: strict parsing, metrics,
caching, approximate counts, update-mode windows, per-batch sums."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vireo.functions.logs import parse_access_log, parse_access_log_strict, rejected_lines
from vireo.operators import aggregate as agg
from vireo.operators import partitioning
from vireo.plans.accesslog import lines_from_events
from vireo.sources.tables import table
from vireo.streaming import queries as sq
from vireo.streaming import sources


def test_strict_parse_raises_and_lenient_counts_rejects(spark):
    lines = lines_from_events(spark, SF_SMALL)
    ok = parse_access_log(lines).count()
    bad = rejected_lines(lines).count()
    assert ok + bad == lines.count() and bad > 0
    with pytest.raises(Exception, match="cannot parse log line"):
        parse_access_log_strict(lines).count()
    good_only = lines.where(~F.col("value").startswith("junk"))
    assert parse_access_log_strict(good_only).count() == ok


def test_dash_size_is_zero(spark):
    df = spark.createDataFrame([('h - - [01/Jan/2024:00:00:01 +0000] "GET /x HTTP/1.0" 200 -',),
                                ('h - - [01/Jan/2024:00:00:01 +0000] "GET /x HTTP/1.0" 200 abc',)], "value string")
    rows = parse_access_log(df).collect()
    assert len(rows) == 1 and rows[0].contentSize == 0


def test_observed_metrics(spark):
    li = table(spark, SF_SMALL, "lineitem").select("l_quantity")
    observed, obs = partitioning.observe_sums(li, {"qty": "l_quantity"})
    observed.write.format("noop").mode("overwrite").save()
    m = obs.get
    assert m["rows"] == li.count() and m["qty"] == li.agg(F.sum("l_quantity")).first()[0]


def test_persisted_releases(spark):
    df = table(spark, SF_SMALL, "orders")
    with partitioning.persisted(df) as d:
        assert d.storageLevel.useMemory and d.count() == df.count()
    assert not df.storageLevel.useMemory


def test_count_approx_interval_contains_truth(spark):
    li = table(spark, SF_SMALL, "lineitem")
    r = agg.count_approx(li, fraction=0.5, confidence=0.999).first()
    assert r.low <= li.count() <= r.high


def test_coalesce_and_letter_partitions(spark):
    c = table(spark, SF_SMALL, "customer").select("c_name")
    assert c.repartition(6).coalesce(2).rdd.getNumPartitions() == 2
    p = partitioning.with_pid(partitioning.partition_by_letter(c, "c_name", ["M"]))
    firsts = p.groupBy("pid").agg(F.collect_set(F.upper(F.substring("c_name", 1, 1))).alias("f")).collect()
    assert all(len(set(r.f)) >= 1 for r in firsts)


def _events_stream(spark, tmp_path):
    """Events as three files written one after another in event-time order
    (the file source orders by modification time)."""
    e = table(spark, SF_SMALL, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    src = str(tmp_path / "ev")
    cuts = [None, "2024-01-10", "2024-01-20", None]
    for lo, hi in zip(cuts, cuts[1:]):
        part = e
        if lo:
            part = part.where(F.col("ts") >= F.lit(lo).cast("timestamp"))
        if hi:
            part = part.where(F.col("ts") < F.lit(hi).cast("timestamp"))
        part.coalesce(1).write.mode("append").parquet(src)
    return e, sources.file_table_stream(spark, src, e.schema, max_files_per_trigger=1)


def test_per_batch_sums(spark, tmp_path):
    e, s = _events_stream(spark, tmp_path)
    out = str(tmp_path / "out")
    q = sq.per_batch(s, lambda b: sq.batch_sums(b.withColumn("one", F.lit(1)), "event_type", ["one"]),
                     out, str(tmp_path / "ck"), trigger={"availableNow": True})
    q.awaitTermination()
    res = spark.read.parquet(out)               # batch_id from the folder names
    assert res.select("batch_id").distinct().count() == 3
    assert res.agg(F.sum("sum_one")).first()[0] == e.count()


def test_update_mode_sliding_window(spark, tmp_path):
    e, s = _events_stream(spark, tmp_path)
    lines = s.select(F.col("event_type").alias("value"), "ts")
    q = sq.start(sq.windowed_word_count(lines, "ts", "4 hours", "2 hours"), "update", "memory",
                 name="win_update", checkpoint=str(tmp_path / "ck"), trigger={"availableNow": True})
    q.awaitTermination()
    got = spark.sql("select window_start, word, max(count) as count from win_update group by 1, 2")
    from vireo.streaming.windows import sliding_counts
    twin = sliding_counts(e.select(F.col("event_type").alias("word"), "ts"), "ts", "4 hours", "2 hours", ["word"])
    a = sorted((r.window_start, r.word, r["count"]) for r in got.collect())
    b = sorted((r.window_start, r.word, r["count"]) for r in twin.collect())
    assert a == b


def test_watermark_on_plain_aggregate_keeps_all_keys(spark, tmp_path):
    from vireo.plans.quotes import quote_stats
    e, s = _events_stream(spark, tmp_path)
    qs = s.select(F.col("event_type").alias("symbol"), F.col("value").alias("close"),
                  F.lit(1.0).alias("qty"), F.col("value").alias("value"), "ts")
    q = sq.start(sq.quote_stats_stream(qs, ts="ts", watermark="30 seconds"), "update", "memory",
                 name="wm_plain", checkpoint=str(tmp_path / "ck"), trigger={"availableNow": True})
    q.awaitTermination()
    got = spark.sql("select symbol, max(totqty) as totqty from wm_plain group by symbol")
    twin = quote_stats(qs.sparkSession.read.parquet(str(tmp_path / "ev")).select(
        F.col("event_type").alias("symbol"), F.col("value").alias("close"), F.lit(1.0).alias("qty"),
        F.col("value").alias("value")))
    assert sorted((r.symbol, r.totqty) for r in got.collect()) == \
        sorted((r.symbol, r.totqty) for r in twin.collect())


def test_in_memory_source_with_partition_count(spark):
    # A driver-side collection with an explicit schema and partition count
    rows = [(i, f"v{i}") for i in range(100)]
    df = spark.createDataFrame(rows, "k int, v string").repartition(4)
    assert df.rdd.getNumPartitions() == 4 and df.count() == 100
    r = spark.range(0, 1000, 1, 7)
    assert r.rdd.getNumPartitions() == 7 and r.agg(F.sum("id")).first()[0] == 499500


def test_windowed_quote_stats_bounded_state(spark, tmp_path):
    from vireo.plans.quotes import quote_stats
    e, s = _events_stream(spark, tmp_path)
    qs = s.select(F.col("event_type").alias("symbol"), F.col("value").alias("close"),
                  F.lit(1.0).alias("qty"), F.col("value").alias("value"), "ts")
    q = sq.start(sq.quote_stats_stream(qs, ts="ts", watermark="1 hour", window="1 day"), "append", "memory",
                 name="wm_window", checkpoint=str(tmp_path / "ck"), trigger={"availableNow": True})
    q.awaitTermination()
    got = spark.sql("select w.start as d, symbol, totqty from wm_window")
    batch = e.select(F.col("event_type").alias("symbol"), F.col("value").alias("close"), F.lit(1.0).alias("qty"),
                     F.col("value").alias("value"), "ts")
    twin = quote_stats(batch, [F.window("ts", "1 day").alias("w"), "symbol"]).select(
        F.col("w.start").alias("d"), "symbol", "totqty")
    a = {(r.d, r.symbol, r.totqty) for r in got.collect()}
    b = {(r.d, r.symbol, r.totqty) for r in twin.collect()}
    assert a and a <= b          # emitted (closed) days are final and equal the batch result


def test_sample_n_with_and_without_replacement(spark):
    from vireo.operators import project
    o = table(spark, SF_SMALL, "orders")
    a = project.sample_n(o, 2, seed=5, with_replacement=True).collect()
    b = project.sample_n(o, 2, seed=5).collect()
    assert len(a) == 2 and len(b) == 2 and len({r.o_orderkey for r in b}) == 2


def test_random_holding_cost_range(spark):
    from vireo.plans.supply import random_holding_cost
    vals = {r.h for r in spark.range(2000).select(random_holding_cost(3).alias("h")).collect()}
    assert vals <= {round(i / 10, 1) for i in range(1, 10)} and len(vals) == 9


def test_log_report_over_one_persisted_parse(spark):
    from vireo.plans import accesslog
    lines = accesslog.lines_from_events(spark, SF_SMALL)
    with partitioning.persisted(parse_access_log(lines)) as logs:
        rep = accesslog.report(logs)
        assert len(rep) == 12 and rep["bad_records"].count() == rep["bad_count"].first().bad
        assert rep["bad_count"].first().bad == logs.where("responseCode = '404'").count()
        assert rep["unique_hosts"].first().hosts == logs.select("ipAddress").distinct().count()


def test_sizing_and_shuffle_width(spark):
    from vireo.session import sizing
    conf = sizing(100 * 1024 ** 4)
    assert conf["spark.sql.shuffle.partitions"] == str(100 * 1024 ** 4 // (256 << 20))
    assert int(sizing(10 * 1024 ** 3)["spark.sql.shuffle.partitions"]) == 40
    before = spark.conf.get("spark.sql.shuffle.partitions")
    partitioning.shuffle_width(spark, 5)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "5"
    partitioning.shuffle_width(spark, int(before))


def test_count_within_time_limit(spark):
    li = table(spark, SF_SMALL, "lineitem")
    mean, low, high = agg.count_within(li, 10000, 0.999)
    n = li.count()
    assert low <= n <= high and abs(mean - n) <= max(1.0, 0.5 * n)


def test_coalesce_share_narrows_without_shuffle(spark):
    wide = spark.range(0, 1000, 1, 8)
    half = partitioning.coalesce_share(wide, 0.5)
    assert half.rdd.getNumPartitions() == 4 and half.count() == 1000
    assert "Exchange" not in half._jdf.queryExecution().executedPlan().toString()
    assert partitioning.coalesce_share(spark.range(0, 3, 1, 1), 0.1).rdd.getNumPartitions() == 1


def test_rows_lie_in_the_partition_of_their_letter(spark):
    names = spark.createDataFrame([(x,) for x in ["Ab", "bz", "Ca", "mm", "Na", "sz", "Ta", "Zz", "1x"]], "name string")
    out = partitioning.with_pid(partitioning.partition_by_letter(names, "name", ["B", "M", "S"])).collect()
    assert {r.name: r.pid for r in out} == {"Ab": 0, "bz": 0, "1x": 0, "Ca": 1, "mm": 1, "Na": 2, "sz": 2, "Ta": 3, "Zz": 3}


def test_zip_partitions_needs_equal_partition_counts(spark):
    from vireo.operators import project
    a = spark.range(0, 100, 1, 4).withColumnRenamed("id", "x")
    with pytest.raises(ValueError):
        project.zip_partitions(a, spark.range(0, 100, 1, 2).withColumnRenamed("id", "y"), "x", "y")
    assert project.zip_partitions(a, spark.range(0, 100, 1, 4).withColumnRenamed("id", "y"), "x", "y").where("x = y").count() == 100


def test_sample_with_replacement_has_its_size(spark):
    from vireo.operators import project
    df = spark.range(0, 5, 1, 3)
    for n in (1, 4, 50):
        got = project.sample_n(df, n, seed=n, with_replacement=True).collect()
        assert len(got) == n and {r.id for r in got} <= set(range(5))
    assert project.sample_n(df.where("id > 9"), 3, seed=1, with_replacement=True).count() == 0


def test_sessions_sum_the_value_as_it_is(spark):
    from vireo.operators.sessions import sessions
    ev = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 10), 0.004), ("a", dt.datetime(2024, 1, 1, 10, 5), 0.004)], "k string, ts timestamp, v double")
    assert sessions(ev, "ts", "30 minutes", ["k"], "v").first().total == 0.008
    as_decimal = ev.withColumn("v", F.col("v").cast("decimal(10,3)"))
    assert str(sessions(as_decimal, "ts", "30 minutes", ["k"], "v").first().total) == "0.008"


def test_retail_exploration_invariants(spark):
    from vireo.plans.retail import explore
    from vireo.plans.standins import retail_lines
    lines = retail_lines(spark, SF_SMALL)
    years = [r.y for r in lines.select(F.year("invoicedate").alias("y")).distinct().collect()]
    ex = explore(lines, sorted(years))
    assert ex["dedup"].count() == lines.dropDuplicates().count()
    total = ex["country_revenue"].agg(F.sum("revenue")).first()[0]
    assert ex["cube"].where("gid = 7").first().revenue == total            # grand total of the cube
    assert ex["rollup"].where("gid = 7").first().revenue == total
    q = ex["unpivot_year_quantity"].agg(F.sum("quantity")).first()[0]
    assert q == lines.dropDuplicates().agg(F.sum("quantity")).first()[0]   # pivot then unpivot keeps totals
    last = ex["running_by_country"].groupBy("country").agg(F.max("cumrevenue").alias("c"))
    per = ex["country_revenue"].join(last, "country").where("c != revenue").count()
    assert per == 0                                                       # running sum ends at the total


def test_retail_lines_are_told_apart_after_the_shuffle(spark, capsys):
    """No task holds the distinct lines of its read split; those that repeat anywhere still go."""
    from vireo.plans.retail import explore
    rows = [("i", q, p, dt.datetime(1995, 1, d), c) for q, p, d, c in [(1.0, 0.0, 1, "x"), (1.0, -0.0, 1, "x"), (1.0, 0.0, 2, "x"), (None, float("nan"), 2, None)]] * 3
    lines = spark.createDataFrame(rows, "description string, quantity double, price double, invoicedate timestamp, country string").repartition(3)
    dedup = explore(lines, [1995])["dedup"]
    assert dedup.count() == 3
    dedup.explain()
    plan = capsys.readouterr().out.split("Initial Plan")[-1]
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "Aggregate" in plan and "Aggregate" not in below


def test_eoq_runs_its_shipments_once(spark):
    """demand and costs share one aggregate that is computed once."""
    from vireo.plans.supply import eoq_tlc
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def weight(i):
        seen.add(1)
        return str(1 + i % 3)

    df = spark.range(30, numPartitions=2).select(
        (F.col("id") % 5).alias("vendorkey"), F.lit("v").alias("vendor"), F.lit("c").alias("country"), (F.col("id") % 2).cast("string").alias("moleculetesttype"),
        weight("id").alias("weightkilograms"), *[F.lit(100).cast("long").alias(c) for c in ("lineitemvalue_cents", "freightcost_e4", "insurance_e4")])
    assert {r.demand for r in eoq_tlc(df).collect()} == {30.0} and seen.value == 30


def test_retail_lines_meet_orders_in_bounded_partitions(spark, capsys, monkeypatch):
    """A join sorts a bounded number of lines a task, however AQE would coalesce, also where the shuffle width is fixed."""
    from vireo.plans import standins
    monkeypatch.setattr(standins, "LINES_A_TASK", 100)
    count = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    parts = standins.line_partitions(spark, SF_SMALL)
    assert parts == -(-count // 100) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    standins.retail_lines(spark, SF_SMALL).explain()
    plan = capsys.readouterr().out
    assert any("l_orderkey" in x and f", {parts})" in x and "REPARTITION_BY_NUM" in x for x in plan.splitlines() if "Exchange hashpartitioning" in x)


def test_retail_lines_meet_parts_in_bounded_partitions(spark, capsys, monkeypatch):
    """The joins with part and customer sort a bounded number of rows a task where the shuffle width is fixed."""
    from vireo.plans import standins
    monkeypatch.setattr(standins, "LINES_A_TASK", 50)
    rows = {t: spark.read.parquet(f"{SF_SMALL}/{t}.parquet").count() for t in ("lineitem", "orders")}
    assert min(rows.values()) // 50 > int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = standins.retail_lines(spark, SF_SMALL)
    lines.explain()
    plan = [x for x in capsys.readouterr().out.splitlines() if "Exchange hashpartitioning" in x and "REPARTITION_BY_NUM" in x]
    for key, table in (("l_partkey", "lineitem"), ("o_custkey", "orders")):
        assert any(key in x and f", {-(-rows[table] // 50)})" in x for x in plan)
    monkeypatch.undo()
    assert lines.exceptAll(standins.retail_lines(spark, SF_SMALL)).count() == 0
    assert lines.count() == standins.retail_lines(spark, SF_SMALL).count()
