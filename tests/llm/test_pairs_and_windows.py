"""Operators 2, 3, 5 and 8 against brute force, on fixtures with nulls, ties, copies, long texts and clashing columns."""

import random
import re
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from vireo.llm import bit_sliced, decontaminate, line_dedup, ngram_join


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edited(rng, text, changes):
    w = text.split(" ")
    for _ in range(changes):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    base = prose(rng, 120)
    texts = [None, "", "!!! ...", "one", "one two", "One, TWO!", "a b c d", "Ünïcode wörds éé", base, base, base.upper()]
    texts += [edited(rng, base, rng.randrange(1, 8)) for _ in range(40)]
    texts += [prose(rng, rng.randrange(1, 200)) for _ in range(60)]
    texts += [prose(rng, 30000, 50000), "x" * 30000, " ".join(["same"] * 5000)]
    return texts


@pytest.fixture
def docs(spark, corpus):
    rows = [(i, t, "a", "b", 1, "c") for i, t in enumerate(corpus)]
    return spark.createDataFrame(rows, "doc_id long, text string, row string, kept string, id int, BAD_ID string").repartition(3)


def test_ngram_join_matches_brute_force(spark, docs, corpus):
    got = {r.doc_id: r for r in ngram_join.join(docs).collect()}
    want = brute.near_duplicates(corpus)
    assert len(got) == len(corpus)
    for i, (n, first) in enumerate(want):
        assert (got[i].n_links, got[i].class_id) == (n, first), i


def test_ngram_join_in_small_blocks_gives_the_same(spark, docs, corpus, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 7)
    got = {r.doc_id: (r.n_links, r.class_id) for r in ngram_join.join(docs).collect()}
    assert got == dict(enumerate(brute.near_duplicates(corpus)))


def test_keep_one_keeps_columns_and_one_row_of_each_class(spark, docs, corpus):
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    want = brute.near_duplicates(corpus)
    classes = Counter(want[r.doc_id][1] for r in kept.collect())
    assert set(classes.values()) == {1} and len(classes) == len({c for _, c in want})


def test_ngram_join_repeated_rows_null_ids_and_empty(spark, docs):
    two = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, "z y x w v u")], "doc_id long, text string")
    assert sorted(tuple(r) for r in ngram_join.join(two).select(F.coalesce("doc_id", F.lit(-1)), F.coalesce("class_id", F.lit(-1)), "n_links").collect()) == [(-1, -1, 0), (-1, 1, 2), (1, 1, 2), (1, 1, 2)]
    assert ngram_join.join(docs.limit(0)).collect() == []


def test_posterior_bound_drops_almost_no_true_pair():
    rng = np.random.default_rng(1)
    least = ngram_join.least_matches(25, 0.8, ngram_join.TOLERANCE)
    assert (rng.binomial(25, 0.8, 10**6) < least).mean() < 1e-5
    assert ngram_join.least_matches(200, 0.8, ngram_join.TOLERANCE) > 100


def test_windows_match_brute_force(spark, docs, corpus):
    rng = random.Random(5)
    base = corpus[8].split(" ")
    items = [(1, " ".join(base[5:40])), (2, " ".join(base[20:26])), (3, "one two"), (4, "one"), (5, None), (6, "..."), (7, prose(rng, 30)),
             (8, " ".join(base[50:60])), (8, " ".join(base[5:40])), (None, " ".join(base[100:115])), (9, "same " * 12), (10, "X" * 30000)]
    frame = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, words int, n int")
    found = decontaminate.find_windows(docs, frame)
    want = brute.windows(corpus, items)
    rows = found.collect()
    assert len(rows) == len(corpus)
    for r in rows:
        n, hit, ids = want[r.doc_id]
        assert (r.n_words, r.n_hit, set(r["items"])) == (n, hit, ids - {None}), r.doc_id
        covered = set()
        for w in r.windows:
            covered.update(range(w.start, w.end))
        assert len(covered) == hit
    clean = decontaminate.decontaminate(docs, frame)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == [i for i, (_, hit, _) in enumerate(want) if not hit]


def test_windows_without_items_or_documents(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in decontaminate.find_windows(docs, none).collect()} == {0}
    assert decontaminate.find_windows(docs.limit(0), none).collect() == []
    twice = spark.createDataFrame([(1, "one two three"), (1, "one two three"), (None, "one two three"), (1, "x")], "doc_id long, text string")
    assert sorted(r.n_hit for r in decontaminate.find_windows(twice, spark.createDataFrame([("i", "Two three")], "item_id string, text string")).collect()) == [0, 2, 2, 2]


def brute_top(vectors, k):
    usable = [(i, [int(np.floor(256.0 * x)) for x in v]) for i, v in vectors if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, a in usable:
        if q % 50 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q and len(a) == len(b))
            out |= {(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored[:k])}
    return out


def test_top_k_matches_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.5, 12)]) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(100)]  # ties
    rows += [(600, None), (601, [0.1, None] + [0.0] * 10), (602, [float("nan")] * 12), (603, [float("inf")] * 12), (650, [float("-inf")] * 12), (604, [1.0] * 3), (605, []), (None, [0.5] * 12), (606, [1e6] * 12), (607, [-1e6] * 12)]
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, id int, block int")
    monkeypatch.setattr(bit_sliced, "BLOCK_ROWS", 64)
    monkeypatch.setattr(bit_sliced, "CHUNK_QUERIES", 3)
    got = bit_sliced.top_k(frame, frame.filter("vec_id % 50 = 0")).select("query_id", "rank", "vec_id", "score").collect()
    assert {tuple(r) for r in got} == brute_top([(i, [float(np.float32(x)) if x is not None else None for x in v] if v else v) for i, v in rows], 5)
    assert len(got) == len(set(got))


def test_top_k_broadcasts_no_query_for_each_block(spark, monkeypatch):
    monkeypatch.setattr(bit_sliced, "BLOCK_ROWS", 20)
    frame = spark.createDataFrame([(i, [float(i % 7), 1.0]) for i in range(300)], "vec_id long, embedding array<double>")
    found = bit_sliced.top_k(frame, frame.filter("vec_id % 50 = 0"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
    assert {tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect()} == brute_top([(i, [float(i % 7), 1.0]) for i in range(300)], 5)


def test_written_slices_add_up_to_every_score():
    rng = np.random.default_rng(4)
    for dims, most in ((1, 1), (4, 300), (7, 300), (9, 2**28), (5, 0)):
        values = rng.integers(-most, most + 1, (130, dims))
        values[:, 0] = 3
        queries = np.r_[values[:70], -values[:70]]
        index = bit_sliced.Slices.unpacked(130, *bit_sliced.Slices(values).packed())
        total, base = index.scores(queries)
        bits = [np.unpackbits(p.view(np.uint8), axis=1, bitorder="little")[:, :130].astype(object) for p in total]
        assert (base[:, None].astype(object) + sum(b << i for i, b in enumerate(bits)) == queries.astype(object) @ values.T.astype(object)).all()


def test_top_k_of_few_or_no_vectors(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (50, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in bit_sliced.top_k(frame, frame).collect()) == [(0, 1, 50, 0), (50, 1, 0, 0)]
    assert bit_sliced.top_k(frame.limit(0), frame).collect() == []
    assert bit_sliced.top_k(frame, frame.limit(0)).collect() == []


@pytest.fixture(scope="module")
def line_texts():
    rng = random.Random(9)
    lines = [prose(rng, 40) for _ in range(20)]
    texts = [None, "", "\n\n", "ab", "AB \nab", "short\nshort\n\nother", "y" * 20000]
    for _ in range(60):
        picked = [edited(rng, rng.choice(lines), rng.choice([0, 0, 1, 2, 12])) for _ in range(rng.randrange(1, 6))]
        texts.append("\n".join(picked + [""] * rng.randrange(2)))
    return texts


def test_lines_match_brute_force(spark, line_texts):
    rows = [(i, t, 0, "x", "y") for i, t in enumerate(line_texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int, kept string, lines string").coalesce(1)
    got = line_dedup.dedup_lines(docs, counts=True)
    assert got.columns == [*docs.columns, "n_lines", "n_removed"]
    classes, count, first = brute.dedup_lines(line_texts)
    class_of = {x: c for c, xs in classes.items() for x in xs}
    seen = Counter()
    for r in got.collect():
        text = line_texts[r.doc_id]
        if text is None:
            assert r.text is None
            continue
        before, after = text.split("\n"), r.text.split("\n")
        kept = [brute.normal(x) for x in after if brute.normal(x)]
        assert r.n_lines == sum(bool(brute.normal(x)) for x in before) and r.n_lines - r.n_removed == len(kept)
        if kept or not r.n_lines:
            assert sum(not brute.normal(x) for x in before) == sum(not brute.normal(x) for x in after)
        for x in kept:
            seen[class_of[x]] += 1
            assert r.doc_id == min(first[y] for y in classes[class_of[x]])
    assert set(seen) == set(classes) and set(seen.values()) == {1}


def test_unlinked_member_of_a_bucket_is_compared_with_the_rest(spark, monkeypatch):
    """With one band of one value nearly everything shares buckets; the classes are still those of the exact links."""
    monkeypatch.setattr(line_dedup, "BANDS", 64)
    monkeypatch.setattr(line_dedup, "ROWS", 1)
    rng = random.Random(4)
    base = [prose(rng, 30, 60) for _ in range(5)]
    texts = [edited(rng, rng.choice(base), rng.randrange(6)) for _ in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = line_dedup.dedup_lines(docs, drop_emptied=True).collect()
    assert len(got) == len(brute.dedup_lines(texts)[0])


def test_line_dedup_of_repeated_rows_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a line that is repeated"), (1, "a line that is repeated"), (None, None)], "doc_id long, text string")
    assert sorted(str(r.text) for r in line_dedup.dedup_lines(docs).collect()) == ["", "None", "a line that is repeated"]
    assert line_dedup.dedup_lines(docs, drop_emptied=True).count() == 2
    assert line_dedup.dedup_lines(docs.limit(0), counts=True).collect() == []


@pytest.mark.parametrize("threshold", [0.8, 0.6])
def test_lines_of_few_shingles_share_a_key_with_every_similar_line(spark, threshold):
    rng = random.Random(12)
    word = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    pairs = []
    for n in [*range(8, 61)] * 8 + [90, 120, 134, 135, 150] * 12:
        s = n - 7
        base = word(n)
        most = int(s / threshold + 1e-9) - s  # shingles that the other may have besides
        head = rng.randrange(most + 1)
        pairs += [(base, base + word(most)), (base, word(head) + base + word(most - head)), (base, base[int(s * (1 - threshold) + 1e-9):])]
    pairs += [("y" * 900, "y" * 8), ("ab" * 30, "ab" * 200), ("abc", "abc")]
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "id long, a string, b string").repartition(4)
    left, right = ({r.id: set(r.bands) for r in line_dedup.with_bands(frame.select("id", x), x, 8, threshold).select("id", "bands").collect()} for x in "ab")
    apart = [i for i in left if not left[i] & right[i]]
    # two lines of LONG shingles and more have bands only
    assert not [(len(pairs[i][0]), len(pairs[i][1])) for i in apart if min(map(len, pairs[i])) - 7 < line_dedup.LONG]


def test_line_lengths_from_which_a_change_inside_links(spark):
    """The lengths that docstring and README name: one character from 79 on, a word of six letters from 124 on."""
    rng = random.Random(14)
    texts = []
    for n, changed in ((78, 1), (79, 1), (123, 6), (124, 6)):
        base = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))
        texts += [base, base[:n // 2] + "0123456"[:changed] + base[n // 2 + changed:]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = sorted(r.doc_id for r in line_dedup.dedup_lines(docs, drop_emptied=True).collect())
    assert got == [0, 1, 2, 4, 5, 6]


def test_short_lines_match_brute_force(spark):
    rng = random.Random(13)
    word = lambda n: "".join(rng.choices("abcdefgh ", k=n)).strip() or "a"
    texts = []
    for n in [*range(10, 61)] * 4:
        base = word(n)
        texts += [base, base + word(max(1, (n - 7) // 4)), base + word(max(1, (n - 7) // 8)), word(2) + base]
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = line_dedup.dedup_lines(docs, drop_emptied=True).collect()
    assert len(got) == len(brute.dedup_lines(texts)[0])


def test_a_long_covered_run_is_shuffled_in_proportion(spark):
    """A document that equals an item of n words: rows with neighbourhoods, not with the whole text."""
    rng = random.Random(4)
    for n in (1000, 4000):
        text = prose(rng, n, 100000)
        docs = spark.createDataFrame([(1, text), (2, text + " tail"), (3, "nothing here")], "doc_id long, text string")
        items = spark.createDataFrame([("i", text)], "item_id string, text string")
        found = {r["doc_id"]: r for r in decontaminate.find_windows(docs, items).collect()}
        assert [found[i]["n_hit"] for i in (1, 2, 3)] == [n, n, 0] and found[1]["items"] == ["i"]
        runs = spark.createDataFrame([(0, text, 1)], "rid long, run string, copies long")
        known = items.select("item_id", decontaminate.item_words(F.col("text")).alias("words")).withColumn("n", F.size("words"))
        rows = decontaminate._verified(runs, known, 10)
        assert rows.count() == n - 9
        # the joins of the plan shuffle no whole text: the words are gone below the generators
        plan = rows._jdf.queryExecution().optimizedPlan()
        joins = [line for line in plan.toString().splitlines() if "Join" in line]
        assert joins and not re.search(r"\b(words|run|item_words)#", "".join(a.toString() for a in _join_outputs(plan)))


def _join_outputs(plan):
    out = []
    for i in range(plan.children().size()):
        out += _join_outputs(plan.children().apply(i))
    if "Join" in plan.nodeName():
        out.append(plan.output())
    return out


def test_line_parities_lose_no_link(spark):
    """op8: of random edits of lines, every pair at the threshold may link by its parities; unlike lines may not."""
    import random
    from pyspark.sql import functions as F
    from vireo.llm import line_dedup as ld
    rng, rows = random.Random(3), []
    for i in range(60):
        line = "".join(rng.choice("abcdefgh ") for _ in range(rng.choice([5, 30, 90, 200])))
        other = "".join(rng.choice("xy") if rng.random() < 0.01 else c for c in line)[rng.randrange(3):]
        rows += [(2 * i, line), (2 * i + 1, other)]
    own = ld.parities(spark.createDataFrame(rows, "nid long, line string"), ld.SHINGLE)
    side = lambda x: own.select(F.col("nid").alias(x), F.col("n").alias(f"n_{x}"), F.col("p").alias(f"p_{x}"))
    both = side("a").crossJoin(side("b")).filter("a < b").select("a", "b", ld.may_link("a", "b", ld.THRESHOLD).alias("may"))
    may = {(r.a, r.b): r.may for r in both.collect()}
    sets = {i: {s[j:j + ld.SHINGLE] for j in range(max(1, len(s) - ld.SHINGLE + 1))} for i, s in rows}
    like = {p for p in may if len(sets[p[0]] & sets[p[1]]) >= ld.THRESHOLD * len(sets[p[0]] | sets[p[1]])}
    assert len(like) > 10 and all(may[p] for p in like)
    assert sum(may.values()) < 2 * len(like) + 60


def test_unlike_members_of_a_crowded_bucket_are_ruled_out_before_they_are_verified(spark, monkeypatch):
    """op8, pipeline: lines with one long passage in common and a head of their own; the classes are exact, and few unlike pairs are verified."""
    from pyspark.sql import functions as F
    from vireo.llm import line_dedup as ld
    rng = random.Random(21)
    word = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    passage = word(400)
    texts = [word(rng.choice([20, 40, 60, *range(90, 200, 10)])) + "." + passage for _ in range(250)]
    rng.shuffle(texts)
    checked, verified = {}, ld.verified

    def counted(pairs, texts, k, threshold, scratch, name):
        checked[name] = pairs.select(F.count("*")).first()[0]
        return verified(pairs, texts, k, threshold, scratch, name)

    monkeypatch.setattr(ld, "verified", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = ld.dedup_lines(docs, drop_emptied=True).collect()
    assert len(got) == len(brute.dedup_lines(texts)[0])
    assert sum(checked.values()) < 8 * len(texts), checked
