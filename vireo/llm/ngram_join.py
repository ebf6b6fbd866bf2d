"""Exact Jaccard self-join of word n-gram sets with Bayesian pruning of candidates.

1. A text becomes its set of ``n`` consecutive words (64-bit hashes), a
   fingerprint of the set and a MinHash signature.  Equal sets are one class.
2. Banded signatures link every class to the smallest class of each bucket.
   Two classes with a common bucket are in one component of these links, so
   no pair is listed to find candidates.
3. A component is dealt into blocks, and each pair of blocks is one bounded
   unit of work.  Inside it MinHash values are compared a few at a time.  A
   pair is dropped when the posterior probability that its similarity reaches
   the threshold falls below the tolerance; the rest are verified exactly.
4. Units return sums and spanning links, never their pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo.llm.common import Scratch, fresh, row_key, slices
from vireo.llm.components import components
from vireo.llm.words import Words, mix

WORDS = 5
THRESHOLD = 0.8
#: 40 bands of 5: a pair at 0.8 misses all bands with probability 1.2e-7.
BANDS, ROWS = 40, 5
HASHES = BANDS * ROWS
#: MinHash values compared before each look at the posterior.
LOOK = 25
#: A pair is dropped if it reaches the threshold with a smaller posterior probability.
TOLERANCE = 1e-9
#: Documents and set elements of a block; a unit holds two blocks.
BLOCK, BLOCK_ELEMENTS = 2048, 1 << 21

_RNG = np.random.default_rng(5)
_MUL = _RNG.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its n-grams; fewer words, but not none, are one n-gram."""
    words = Words(column)
    h, _ = words.shingles(n)
    for a, b in zip(words.rows[:-1].tolist(), words.rows[1:].tolist()):
        if b - a >= n:
            yield np.unique(h[a:b - n + 1])
        elif b > a:
            yield mix(np.bitwise_xor.reduce(mix(words.hashes[a:b] + np.arange(1, b - a + 1, dtype=np.uint64)), keepdims=True) + np.uint64(b - a))
        else:
            yield np.empty(0, np.uint64)


def signature(items: np.ndarray) -> np.ndarray:
    """HASHES MinHash values of a set of 64-bit hashes (not empty)."""
    x = (items >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 2048):
        np.minimum(out, (x[at:at + 2048, None] * _MUL + _ADD).min(axis=0), out=out)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    v = sig.reshape(BANDS, ROWS).astype(np.uint64)
    acc = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        acc = mix(acc * _STEP + v[:, j])
    return acc.view(np.int64)


def least_matches(compared: int, threshold: float, tolerance: float) -> int:
    """Fewest matches of ``compared`` values for which P(similarity >= threshold) >= tolerance.

    With a uniform prior the similarity is Beta(m+1, compared-m+1), and its
    upper tail is a binomial sum: P(Binomial(compared+1, threshold) <= m).
    """
    total = 0.0
    for m in range(compared + 1):
        total += math.comb(compared + 1, m) * threshold**m * (1 - threshold) ** (compared + 1 - m)
        if total >= tolerance:
            return m
    return compared + 1


def linked_pairs(sigs: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float, tolerance: float) -> Iterator[tuple[int, np.ndarray]]:
    """(i, js): the members of ``right`` whose Jaccard similarity with ``left`` member i is >= threshold (j > i where both sides are one block)."""
    sizes = np.array([len(s) for s in sets])
    ids, inverse = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    flag = np.zeros(len(ids), bool)
    looks = [(n, least_matches(n, threshold, tolerance)) for n in range(LOOK, sigs.shape[1] + 1, LOOK)]
    same = left is right
    for i in left.tolist():
        js = right[right > i] if same else right
        js = js[np.minimum(sizes[js], sizes[i]) >= threshold * np.maximum(sizes[js], sizes[i]) - 1e-9]
        matches = np.zeros(len(js), np.int32)
        for n, least in looks:
            if not len(js):
                break
            matches += (sigs[js, n - LOOK:n] == sigs[i, n - LOOK:n]).sum(axis=1)
            keep = matches >= least
            js, matches = js[keep], matches[keep]
        if not len(js):
            continue
        flag[inverse[starts[i]:ends[i]]] = True
        if len(js) > 8:
            picked = np.concatenate([inverse[starts[j]:ends[j]] for j in js.tolist()])
            common = np.add.reduceat(flag[picked], np.cumsum(sizes[js]) - sizes[js], dtype=np.int64)
        else:
            common = np.array([np.count_nonzero(flag[inverse[starts[j]:ends[j]]]) for j in js.tolist()])
        flag[inverse[starts[i]:ends[i]]] = False
        js = js[common >= threshold * (sizes[js] + sizes[i] - common) - 1e-9]
        if len(js):
            yield i, js


def _unit(rows: np.ndarray, blocks: np.ndarray, lo: int, hi: int, copies: np.ndarray, sigs: np.ndarray, sets: list[np.ndarray], threshold: float, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Per member: documents that it links to inside this unit, and the smallest member that links lead to."""
    links, label = np.zeros(len(rows), np.int64), np.arange(len(rows))
    left = np.flatnonzero(blocks == lo)
    right = left if lo == hi else np.flatnonzero(blocks == hi)
    heads, tails = [], []
    for i, js in linked_pairs(sigs, sets, left, right, threshold, tolerance):
        links[i] += copies[js].sum()
        links[js] += copies[i]
        # a star is enough for connection: the pairs themselves are not kept
        heads.append(np.full(len(js), i))
        tails.append(js)
        if len(heads) > 512:
            label = _settle(label, np.concatenate(heads), np.concatenate(tails))
            heads, tails = [], []
    if heads:
        label = _settle(label, np.concatenate(heads), np.concatenate(tails))
    return links, label


def _settle(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


class _Units:
    """Cuts a stream of Arrow batches, sorted by unit, into units and compares each."""

    def __init__(self, threshold: float, tolerance: float):
        self.threshold, self.tolerance = threshold, tolerance

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[pa.RecordBatch] = []
        key = None
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                if key is not None and (keys[a] != key).any():
                    yield from self._compare(pending, key)
                    pending = []
                key = keys[a]
                pending.append(batch.slice(a, b - a))
        if pending:
            yield from self._compare(pending, key)

    def _compare(self, parts: list[pa.RecordBatch], key: np.ndarray) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(parts).combine_chunks()
        rows = table["row"].to_numpy()
        order = np.argsort(rows, kind="stable")
        rows = rows[order]
        if len(rows) < 2:
            return
        sigs = np.stack([np.frombuffer(x.as_py(), np.uint16) for x in table["sig"]])[order]
        raw = table["items"]
        sets = [np.frombuffer(raw[i].as_py(), np.uint64) for i in order.tolist()]
        links, label = _unit(rows, table["block"].to_numpy()[order], int(key[1]), int(key[2]), table["copies"].to_numpy()[order], sigs, sets, self.threshold, self.tolerance)
        hit = np.flatnonzero(links)
        yield pa.RecordBatch.from_arrays([pa.array(rows[hit]), pa.array(links[hit]), pa.array(rows[label[hit]])], ["row", "links", "root"])


def near_duplicates(keyed: DataFrame, scratch: Scratch, row: str = "row", text: str = "text", ident: str = "doc_id", n: int = WORDS, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """Per row of ``keyed``: (row, id, n_shingles, n_links, class_id, class_row).

    ``keyed`` is a written table whose long column ``row`` is unique.  n_links
    counts the other rows with similarity >= ``threshold``; class_id is the
    smallest id, and class_row the smallest row, of those that links connect.
    A text of fewer than ``n`` words, but not none, is one shingle.  Null and
    wordless texts have no shingles: no links, and each is its own class.
    Repeated rows are copies and link to each other.  A class of null ids has
    a null class_id.  Jobs run when it is called.
    """
    id_type = keyed.schema[ident].dataType.simpleString()
    source = keyed.select(F.col(row).alias("row"), F.col(ident).alias("id"), F.col(text).cast("string").alias("text"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                size, fp1, fp2, sigs, bands = [], [], [], [], []
                for items in shingle_sets(part.column(2), n):
                    size.append(len(items))
                    digest = np.frombuffer(hashlib.blake2b(items.tobytes(), digest_size=16).digest(), np.int64)
                    sig = signature(items) if len(items) else None
                    fp1.append(int(digest[0]))
                    fp2.append(int(digest[1]))
                    sigs.append(None if sig is None else (sig & np.uint32(0xFFFF)).astype(np.uint16).tobytes())
                    bands.append(None if sig is None else band_keys(sig))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(size, pa.int64()), pa.array(fp1, pa.int64()), pa.array(fp2, pa.int64()),
                                                  pa.array(sigs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], ["row", "id", "n", "fp1", "fp2", "sig", "bands"])

    marks = scratch.cut(source.mapInArrow(describe, f"row long, id {id_type}, n long, fp1 long, fp2 long, sig binary, bands array<long>"), "marks")
    sets = marks.filter("n > 0")
    # the extra key only separates the exchange from the later join on the fingerprint, so that AQE can split a hot class there
    classes = scratch.cut(sets.groupBy("fp1", "fp2", F.pmod("fp1", F.lit(7)).alias("_")).agg(F.min("row").alias("row"), F.count("*").alias("copies"), F.min("id").alias("min_id")).drop("_"), "classes")
    reps = sets.join(classes.select("row", "copies"), "row")
    rows = reps.select("row", F.explode("bands").alias("key"))
    hubs = rows.groupBy("key", F.pmod("key", F.lit(7)).alias("_")).agg(F.min("row").alias("hub"), F.count("*").alias("c")).filter("c > 1").select("key", "hub")
    edges = rows.join(hubs, "key").filter("row != hub").select("row", "hub").distinct()
    groups = components(edges, "row", "hub", scratch, "near").withColumnRenamed("node", "row")
    groups = scratch.cut(groups, "groups")
    members = groups.join(reps.select("row", "n", "sig", "copies"), "row")
    deal = F.greatest(F.ceil(F.count("*") / F.lit(BLOCK)), F.ceil(F.sum("n") / F.lit(BLOCK_ELEMENTS))).cast("int")
    blocks = members.groupBy("component", F.pmod("component", F.lit(7)).alias("_")).agg(deal.alias("blocks")).select("component", "blocks")
    dealt = members.join(blocks, "component").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))

    def itemise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                items = [s.tobytes() for s in shingle_sets(part.column(1), n)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(items, pa.binary())], ["row", "items"])

    texts = source.select("row", "text").join(groups.select("row"), "row", "left_semi").mapInArrow(itemise, "row long, items binary")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    units = (dealt.join(texts, "row").select("component", "block", other.alias("other"), "row", "copies", "sig", "items")
             .select("component", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "row", "copies", "sig", "items"))
    found = units.repartition("component", "lo", "hi").sortWithinPartitions("component", "lo", "hi").mapInArrow(_Units(threshold, tolerance), "row long, links long, root long")
    found = scratch.cut(found, "found")
    roots = components(found.filter("row != root"), "row", "root", scratch, "class").select(F.col("node").alias("row"), F.col("component").alias("root"))
    total = found.groupBy("row").agg(F.sum("links").alias("links"))
    linked = classes.join(total, "row", "left").join(roots, "row", "left").select("fp1", "fp2", "copies", "min_id", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "row").alias("root"))
    least = linked.groupBy("root", F.pmod("root", F.lit(7)).alias("_")).agg(F.min("min_id").alias("class_id")).select("root", "class_id")
    linked = linked.join(least, "root").select("fp1", "fp2", (F.col("links") + F.col("copies") - 1).alias("n_links"), "class_id", F.col("root").alias("class_row"))
    out = sets.select("row", "id", "n", "fp1", "fp2").join(linked, ["fp1", "fp2"]).select("row", "id", F.col("n").alias("n_shingles"), "n_links", "class_id", "class_row")
    alone = marks.filter("n = 0").select("row", "id", F.col("n").alias("n_shingles"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("class_id"), F.col("row").alias("class_row"))
    out = scratch.cut(out.union(alone), "near_duplicates")
    scratch.drop("marks", "classes", "groups", "found")
    return out


def join(docs: DataFrame, text: str = "text", ident: str = "doc_id", n: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, n_links, n_shingles) of every row of ``docs``; see :func:`near_duplicates`."""
    scratch = Scratch(docs.sparkSession)
    keyed = scratch.cut(docs.select(F.col(ident).alias("id"), F.col(text).alias("text"), row_key().alias("row")), "keyed")
    found = near_duplicates(keyed, scratch, ident="id", n=n, threshold=threshold)
    scratch.drop("keyed")
    return found.select(F.col("id").alias(ident), "class_id", "n_links", "n_shingles")


def keep_one(docs: DataFrame, n: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class of near-duplicates (the first as written); columns unchanged."""
    scratch = Scratch(docs.sparkSession)
    row = fresh("row", docs.columns)
    keyed = scratch.cut(docs.withColumn(row, row_key()), "keyed")
    found = near_duplicates(keyed, scratch, row=row, n=n, threshold=threshold)
    lost = found.filter("row != class_row").select(F.col("row").alias(row))
    return keyed.join(lost, row, "left_anti").select(*docs.columns)
