"""Caller-given combiners: hot keys, many keys, null and NaN keys, empty frames; the streaming wait and the file queries."""

import pickle
import random

import pytest
from pyspark.sql import functions as F

from vireo.operators import combiners
from vireo.operators.combiners import Combiner, combine_general, tree_general


def longest_words() -> Combiner:
    """The three longest distinct words and the number of rows."""
    top = lambda words: sorted(set(words), key=lambda w: (-len(w), w))[:3]
    return Combiner(lambda: (0, []), lambda s, rows: (s[0] + rows.num_rows, top(s[1] + [w for w in rows.column("word").to_pylist() if w is not None])),
                    lambda a, b: (a[0] + b[0], top(a[1] + b[1])), lambda s: (s[0], s[1]), "n long, longest array<string>")


def expected(rows, keys):
    groups = {}
    for r in rows:
        groups.setdefault(tuple(r[k] for k in keys), []).append(r[-1])
    return {k: (len(v), sorted({w for w in v if w is not None}, key=lambda w: (-len(w), w))[:3]) for k, v in groups.items()}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = [(None, "x", None), (None, None, "nul"), (1, None, "a" * 30)]
    out += [(7 if rng.random() < .4 else rng.randrange(500), rng.choice(["x", "y"]), "w" * rng.randrange(1, 20) + str(rng.randrange(9))) for _ in range(6000)]
    return out


@pytest.mark.parametrize("open_keys,fanout", [(20000, 64), (10, 3)])
def test_combine_general(spark, rows, open_keys, fanout, monkeypatch):
    monkeypatch.setattr(combiners, "OPEN_KEYS", open_keys)
    df = spark.createDataFrame(rows, "k int, g string, word string").repartition(9)
    found = {(r["k"], r["g"]): (r["n"], r["longest"]) for r in combine_general(df, ["k", "g"], ["word"], longest_words(), fanout).collect()}
    assert found == expected(rows, [0, 1])


def test_nan_keys_are_one_and_nothing_has_no_key(spark):
    df = spark.createDataFrame([(float("nan"), "a"), (float("nan"), "bb"), (1.5, "c")], "k double, word string").repartition(3)
    assert sorted((r["n"], r["longest"]) for r in combine_general(df, "k", ["word"], longest_words()).collect()) == [(1, ["c"]), (2, ["bb", "a"])]
    assert combine_general(df.limit(0), "k", ["word"], longest_words()).count() == 0


def test_a_hot_key_moves_as_states(spark, tmp_path):
    """What is shuffled has a row per key and task, not a row per input row."""
    df = spark.range(50000, numPartitions=4).select(F.lit(1).alias("k"), F.col("id").cast("string").alias("word"))
    folded = df.mapInArrow(combiners._partial(longest_words(), ["k"], ["word"]), "k int, s binary")
    states = folded.collect()
    assert len(states) == 4 and sum(pickle.loads(bytes(r["s"]))[0] for r in states) == 50000


@pytest.mark.parametrize("parts,fanout", [(1, 64), (7, 2), (9, 3)])
def test_tree_general(spark, rows, parts, fanout):
    df = spark.createDataFrame(rows, "k int, g string, word string").repartition(parts)
    row = tree_general(df, ["word"], longest_words(), fanout).collect()
    assert [(r["n"], r["longest"]) for r in row] == [expected(rows, [])[()]]


def test_tree_general_of_nothing(spark):
    df = spark.createDataFrame([], "word string")
    assert [tuple(r) for r in tree_general(df, ["word"], longest_words()).collect()] == [(0, [])]


def test_recorder_waits_for_a_run(spark, tmp_path):
    from vireo.streaming.listener import ProgressRecorder
    recorder = ProgressRecorder()
    with pytest.raises(TimeoutError):
        recorder.wait_terminated("no such run", timeout=0.1)


def test_min_of_arrow_prices_ignores_nothing(spark):
    from vireo.plans.catalog_combiners import _LINES, mean_and_cheapest
    df = spark.createDataFrame([(1.0, 5.0, 2, 1), (3.0, 5.0, 1, 9), (2.0, 7.0, 0, 0)], "l_quantity double, l_extendedprice double, l_orderkey long, l_linenumber int")
    assert [tuple(r) for r in tree_general(df, _LINES, mean_and_cheapest()).collect()] == [(3, 2.0, 5.0, 1, 9)]


def test_tree_general_folds_in_the_tasks_that_read(spark):
    """the last merge takes states only; it does not make one task of the scan."""
    seen = spark.sparkContext.accumulator(0)
    c = longest_words()
    add = c.add

    def counted(state, rows):
        from pyspark import TaskContext
        seen.add(1 << (10 * TaskContext.get().partitionId()))
        return add(state, rows)

    c.add = counted
    df = spark.range(40, numPartitions=4).select(F.col("id").cast("string").alias("word"))
    assert [r["n"] for r in tree_general(df, ["word"], c).collect()] == [40]
    assert seen.value == sum(1 << (10 * i) for i in range(4))


def test_many_keys_are_added_once_a_task(spark):
    """rows of a key that lie apart reach ``add`` together, however many keys there are."""
    calls = spark.sparkContext.accumulator(0)
    c = longest_words()
    add = c.add

    def counted(state, rows):
        calls.add(1)
        return add(state, rows)

    c.add = counted
    df = spark.range(0, 40000, numPartitions=2).select((F.col("id") % 2000).alias("k"), F.lit("w").alias("word"))
    found = combine_general(df, "k", ["word"], c).collect()
    assert len(found) == 2000 and {r["n"] for r in found} == {20}
    assert calls.value < 2 * 2000 + 100  # a key whose rows cross two Arrow batches takes one call more


def test_few_and_many_rows_give_one_state(monkeypatch, spark):
    """Both ways of ``mean_and_cheapest``, with nulls, give the state that SQL does."""
    import pyarrow as pa

    from vireo.plans import catalog_combiners as cc
    rows = pa.RecordBatch.from_pylist([{"l_quantity": q, "l_extendedprice": p, "l_orderkey": o, "l_linenumber": n} for q, p, o, n in
                                       [(1.0, 5.0, 2, 1), (None, 5.0, 1, 9), (2.0, None, 0, 0), (4.0, 7.0, 0, 0)]])
    none = pa.RecordBatch.from_pylist([{"l_quantity": None, "l_extendedprice": None, "l_orderkey": 1, "l_linenumber": 1}], rows.schema)
    for few in (0, 20):
        monkeypatch.setattr(cc, "FEW", few)
        c = cc.mean_and_cheapest()
        assert c.add(c.zero(), rows) == (4, 7.0, (5.0, 1, 9))
        assert c.finish(c.add(c.zero(), none)) == (1, None, None, None, None)
        assert c.merge(c.add(c.zero(), none), c.add(c.zero(), rows)) == (5, 7.0, (5.0, 1, 9))
