"""Operators 11, 12 and 13 against brute force, with nulls, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import heapq
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from vireo.llm import collocations, suffix_dedup, turn_repair
from vireo.llm.common import Scratch
from vireo.llm.words import text_bytes


# --- 11 ----------------------------------------------------------------------
def phrases(rows, longest, least, inside, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, count in f.items():
        known = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        best = []
        for p, a in known.items():
            score, k = min((1000000 * a * a // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
            around = [b for q, b in known.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))]
            if not any(100 * b >= inside * a for b in around):
                best.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


@pytest.fixture(scope="module")
def spoken():
    rng = random.Random(11)
    vocabulary = ["the", "of", "Über", "a", "New", "york", "city", "é", "x y", "ZÉ"]
    rows = [(None, "a b"), ("en", None), ("en", ""), ("", "a b. a b"), ("en", " \t.,;\n"), ("und", "the of the of")]
    for i in range(60):
        words = [rng.choice(vocabulary) + rng.choice(["", "", "", ",", ".", "\n", "  \t"]) for _ in range(rng.randrange(1, 60))]
        rows.append((rng.choice(["en", "de", None]), " ".join(words)))
    rows += [("en", "new york city " * 3000)] + [("de", "Hot Pair")] * 200
    return rows


@pytest.mark.parametrize("longest,top", [(3, 2000), (2, 5), (4, 40)])
def test_collocations_equal_brute_force(spark, spoken, longest, top):
    docs = spark.createDataFrame([(t, g, "x", 1, "y") for g, t in spoken], "text string, lang string, grp string, n int, w1 string").repartition(3)
    found = collocations.collocations(docs, longest=longest, least=3, top=top)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in found.collect()) == phrases(spoken, longest, 3, 50, top)


def test_collocations_of_nothing(spark):
    assert collocations.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0


def test_scores_are_exact_past_64_bits(spark):
    a, l, r = 999_999_999_999, 1_000_000_000_001, 3_000_000_000_007
    row = spark.range(1).select(F.call_function("div", F.lit(1000000).cast("decimal(7,0)") * (F.lit(a).cast(collocations.COUNT) * F.lit(a).cast(collocations.COUNT)),
                                                F.lit(l).cast(collocations.COUNT) * F.lit(r).cast(collocations.COUNT)).alias("s")).first()
    assert row["s"] == 1000000 * a * a // (l * r)


# --- 12 ----------------------------------------------------------------------
def cheapest(rows):
    """(cost, audit, repaired) by uniform-cost search over (cost, audit)."""
    seen, faults = set(), []
    for _, role, text in rows:
        inner = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not inner else "duplicate" if (role, text) in seen else "truncated" if inner[-1] not in ".!?" else "ok")
        seen.add((role, text))
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, told = heapq.heappop(heap)
        if i == len(rows) and state in ("", "a"):
            return cost, audit, "\n".join(told), faults
        if (cost, audit, i, state) in done:
            continue
        done.add((cost, audit, i, state))
        turn = "a" if state == "u" else "u"
        full = {"u": "user", "a": "assistant"}[turn]
        if audit[-3:] != "III":
            heapq.heappush(heap, (cost + 5, audit + "I", i, turn, (*told, full + ":")))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, state, told))
            if faults[i] not in ("blank", "duplicate"):
                more = 5 * (faults[i] == "truncated")
                heapq.heappush(heap, (cost + 1 + more, audit + "R", i + 1, turn, (*told, f"{full}:{text}")))
                if role[:1] == turn or role[:1] == "s" and state == "":
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[:1], (*told, f"{role}:{text}")))


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(12)
    rows = []
    for conv in [None, *range(150)]:
        for turn in range(rng.randrange(1, 8)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", " "])
            rows.append((conv, None if rng.random() < .05 else turn + rng.randrange(2), role, rng.choice(["Hi.", "Yes!", " \t", "", "cut off", "Why?", "é", f"T{turn}."])))
    return rows


@pytest.mark.parametrize("block", [12, 1])
def test_repair_equals_search(spark, talks, block, monkeypatch):
    monkeypatch.setattr(turn_repair, "BLOCK", block)  # blocks of two rows: conversations span several
    frame = spark.createDataFrame([(*r, 1, "x") for r in talks], "conv_id long, turn long, role string, text string, at int, block string").repartition(5)
    edits, totals = turn_repair.repair(frame, Scratch(spark))
    found, counts = defaultdict(list), {r["conv"]: r for r in totals.collect()}
    for r in edits.collect():
        found[r["conv"]].append(r)
    for conv in {r[0] for r in talks}:
        rows = sorted([r[1:] for r in talks if r[0] == conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        cost, audit, repaired, faults = cheapest(rows)
        mine = sorted(found[conv], key=lambda r: tuple(r["at"]))
        assert "".join(r["edit"] for r in mine) == audit and counts[conv]["cost"] == cost
        assert "\n".join(f"{r['role']}:{r['text']}" for r in mine if r["edit"] != "D") == repaired
        turns = [r[0] for r in rows if r[0] is not None]
        assert counts[conv]["gaps"] == (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0)
        assert [counts[conv][k] for k in ("blank", "duplicate", "truncated")] == [faults.count(k) for k in ("blank", "duplicate", "truncated")]
        assert counts[conv]["illegal"] == sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))


def test_long_runs_use_powers_and_nothing_is_empty(spark):
    one = bytes([2 * 4 + 1])
    assert turn_repair.matrix(one * 1000) == turn_repair._times(turn_repair.matrix(one * 487), turn_repair.matrix(one * 513))
    edits, totals = turn_repair.repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string"), Scratch(spark))
    assert edits.count() == 0 and totals.count() == 0


def test_damage(spark):
    import zlib
    rows = [(c, t, r, x) for c in (None, *range(30)) for t, r, x in [(None, "user", "A."), (0, None, None), (1, "assistant", "B? c!"), (2, "user", "")]]
    wanted = Counter()
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        if kind:
            wanted[c, t, "user" if kind == 4 else r, "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x] += 2 if kind == 3 else 1
    assert Counter(tuple(r) for r in turn_repair.damage(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()) == wanted


# --- 13 ----------------------------------------------------------------------
def without_repeats(rows, length):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for s in range(len(b) - length + 1):
            if i is not None:
                first[b[s:s + length]] = min(i, first.get(b[s:s + length], i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for s in range(len(b) - length + 1):
            if i is not None and first[b[s:s + length]] < i:
                gone[s:s + length] = [True] * length
        out.append((i, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest(), sum(gone)))
    return Counter(out)


@pytest.mark.parametrize("length", [50, 48, 79])
def test_removed_bytes_equal_brute_force(spark, length):
    rng = random.Random(13)
    words = [f"wörd{i}" if i % 3 else "é" * (i % 7 + 1) for i in range(300)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, copy = prose(40), prose(120)
    rows = [(1, None), (2, ""), (3, "short"), (4, "x" * 400), (4, "x" * 400), (5, "x" * 49), (6, "x" * 50), (7, "ab" * 100), (8, "ba" * 100), (None, copy), (None, copy)]
    rows += [(100 + i, prose(rng.randrange(1, 90))) for i in range(40)]
    rows += [(200 + i, prose(rng.randrange(20)) + passage + prose(rng.randrange(20))) for i in range(20)]
    rows += [(300 + i // 2, copy) for i in range(12)] + [(400 + i, copy[:i * 20] + "#" + copy[i * 20:]) for i in range(20)]
    rows += [(500, copy[3:len(passage) // 2]), (501, passage[:length].encode()[:length].decode("utf-8", "ignore")), (0, passage[7:90]), (502, copy + copy)]
    docs = spark.createDataFrame([(t, i, "s", 1, b"k", "r") for i, t in rows], "text string, doc_id long, SPANS string, id int, kept binary, hash string").repartition(4)
    out = suffix_dedup.remove_repeats(docs, length=length)
    assert out.columns == ["text", "doc_id", "id", "hash", "spans", "kept"]
    found = Counter((r["doc_id"], hashlib.sha256(r["kept"]).hexdigest(), sum(s["end"] - s["start"] for s in r["spans"])) for r in out.collect())
    assert found == without_repeats(rows, length)


def test_remove_repeats_writes_no_more_than_the_texts_at_a_time(spark, monkeypatch):
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(900)}" for _ in range(400)) for _ in range(6)]
    written = {}

    class Counted(suffix_dedup.Scratch):
        def cut(self, df, name, *args):
            out = super().cut(df, name, *args)
            held = [F.octet_length(c) for c, kind in out.dtypes if kind in ("string", "binary")]
            written[name] = sum(out.select(F.coalesce(F.sum(x), F.lit(0)).alias("n")).first().n for x in held)
            return out

    monkeypatch.setattr(suffix_dedup, "Scratch", Counted)
    docs = spark.createDataFrame([(i, texts[i % 6]) for i in range(12)], "doc_id long, text string")  # every position is shared
    kept = {r.doc_id: bytes(r.kept).decode() for r in suffix_dedup.remove_repeats(docs).collect()}
    assert kept == {i: texts[i] if i < 6 else "" for i in range(12)}
    assert max(written.values()) <= 1.1 * 2 * sum(map(len, texts)), written


def test_ranks_of_two_ids_are_named_across_batches_and_parts():
    rng = random.Random(1)
    words = [f"word{i}" for i in range(60)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(12, 30))) for _ in range(300)]
    batches = [pa.RecordBatch.from_pydict({"id": [rng.randrange(200) for _ in range(100)], "text": texts[i:i + 100]}) for i in (0, 100, 200)]
    asked = pa.Table.from_batches(list(suffix_dedup._asked(50, 7)(iter(batches))))
    got = [x for k in range(7) for x in suffix_dedup._shared(asked.filter(pc.equal(asked["part"], k)))["rank"].to_pylist()]
    ids = {}
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for rank, place, _, _ in suffix_dedup.sampled(data, offsets, 50):
            for name, row in zip((rank >> suffix_dedup._FREE).tolist(), np.searchsorted(offsets, place, "right") - 1):
                ids.setdefault(name, set()).add(batch.column("id")[int(row)].as_py())
    need = {name for name, of in ids.items() if len(of) > 1}
    assert need and len(got) == len(set(got)) and need <= set(got) and len(set(got)) < len(ids)


def test_remove_repeats_of_nothing_and_pieces(spark, monkeypatch):
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    import numpy as np
    data = np.frombuffer(("the same again and " * 60).encode() + bytes(range(65, 91)) * 9, np.uint8)
    whole = {(int(p), s) for r, p, a, z in suffix_dedup.sampled(data, np.array([0, len(data)]), 50) for p, a, z in zip(p, a, z) for s in range(a, z + 1)}
    monkeypatch.setattr(suffix_dedup, "PIECE", 7)
    assert whole == {(int(p), s) for r, p, a, z in suffix_dedup.sampled(data, np.array([0, len(data)]), 50) for p, a, z in zip(p, a, z) for s in range(a, z + 1)}


def test_the_lowest_rank_of_a_window_and_its_place_are_one_minimum():
    import time
    import numpy as np
    few = np.random.default_rng(3).integers(0, 3, 400).astype(np.uint64) << np.uint64(60)  # many ties
    near = few + np.random.default_rng(4).integers(0, 2, 400).astype(np.uint64)             # and ranks that differ in their last bit
    for width in (1, 2, 3, 35, 64):
        assert suffix_dedup._lowest(few, width).tolist() == [i + int(np.argmin(few[i:i + width])) for i in range(400 - width + 1)]
        # a string's place does not depend on how many ranks are looked at with it
        here = suffix_dedup._lowest(near[50:50 + width], width) + 50
        assert here.tolist() == suffix_dedup._lowest(np.concatenate([near] * 50), width)[50:51].tolist()
    data = np.random.default_rng(5).integers(0, 256, 1 << 18).astype(np.uint8)
    ranks = suffix_dedup.ranks16(data)

    def least(work):
        took = []
        for _ in range(7):
            start = time.process_time()
            work()
            took.append(time.process_time() - start)
        return min(took)

    assert least(lambda: suffix_dedup._lowest(ranks, 35)) < 3 * least(lambda: suffix_dedup.ranks16(data))
