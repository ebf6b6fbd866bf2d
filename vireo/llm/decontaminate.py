"""Benchmark windows inside documents: a prefix-filtered set join.

1. One pass over the texts marks the words covered by item shingles (a bitmap
   of fixed size) and keeps each run of covered words that is long enough to
   hold a window.  A window's shingles are all item shingles, so every
   occurrence lies inside one run.
2. Equal runs become one row.  Shingles of the runs, counted over all
   documents, give the rarity order.
3. A window can only occur where its rarest shingle does (containment needs a
   prefix of one token), so only that one is joined.  Length and positional
   bounds follow, then the words are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vireo.llm.common import Scratch, fresh, row_key, slices
from vireo.llm.words import WORD_PATTERN, Words

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SHINGLE = 3
#: Bits of the shingle bitmap: 16 for each item shingle, up to 16 MB.
MIN_BITS, MAX_BITS, BITS_PER_SHINGLE = 1 << 16, 1 << 27, 16

MARKS = "doc_id {id}, text_hash long, n_words long, runs array<struct<start:int,words:string>>"


def item_words(text: Column) -> Column:
    """The words of an item as an array; null has none."""
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    return F.regexp_extract_all(low, F.lit(f"({WORD_PATTERN})"), F.lit(1))


def _slots(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bit positions of a hash."""
    return h & np.uint64(bits - 1), (h >> np.uint64(32)) & np.uint64(bits - 1)


def _bitmap(items: DataFrame, sizes: list[int], bits: int) -> np.ndarray:
    """The bitmap of all item shingles: ``bits`` / 64 words, whatever the number of items."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column(0))
                n = words.counts()
                for k in sizes:
                    h, ok = words.shingles(k)
                    size = np.repeat(np.minimum(n, SHINGLE), n)[:len(h)]
                    spots = np.concatenate(_slots(h[ok & (size == k)], bits))
                    yield pa.RecordBatch.from_arrays([pa.array((spots >> np.uint64(6)).astype(np.int32)),
                                                      pa.array((np.uint64(1) << (spots & np.uint64(63))).view(np.int64))], ["slot", "mask"])

    rows = (items.select(F.col("text").cast("string").alias("text")).mapInArrow(hashed, "slot int, mask long")
            .groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow())
    out = np.zeros(bits >> 6, np.uint64)
    out[rows["slot"].to_numpy()] = rows["mask"].to_numpy().view(np.uint64)
    return out


def _runs(words: Words, bitmap: np.ndarray, sizes: list[int], shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last+1 word of every run of covered words with at least ``shortest`` words."""
    n, bits = len(words.hashes), len(bitmap) << 6
    edge = np.zeros(n + 1, np.int32)
    for k in sizes:
        h, ok = words.shingles(k)
        at = np.flatnonzero(ok)
        for spot in _slots(h, bits):
            spot = spot[at]
            at = at[(bitmap[spot >> np.uint64(6)] >> (spot & np.uint64(63))) & np.uint64(1) == 1]
        np.add.at(edge, at, 1)
        np.add.at(edge, at + k, -1)
    covered = np.cumsum(edge[:-1]) > 0
    row_start = np.zeros(n + 1, bool)
    row_start[words.rows] = True
    begin, end = covered.copy(), covered.copy()
    begin[1:] &= ~covered[:-1] | row_start[1:-1]
    end[:-1] &= ~covered[1:] | row_start[1:-1]
    first, last = np.flatnonzero(begin), np.flatnonzero(end) + 1
    long = last - first >= shortest
    return first[long], last[long]


def find_windows(docs: DataFrame, items: DataFrame, window: int = 10, scratch: Scratch | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): which words lie in an occurrence of an item window.

    ``items`` has item_id and text.  A window is ``window`` consecutive item
    words; an item of fewer words, but not none, is one window.  Returns
    (doc_id, text_hash, n_words, n_hit, items, windows): the distinct item_ids
    with an occurring window, and the word ranges [start, end) of the
    occurrences.  Null and wordless texts have no words and no hits; repeated
    rows and ids give a row each; an item with a null id marks words but is not
    listed; without items nothing is hit.  Other columns are not read.

    The whole of every text is read.  Jobs run when it is called: the items'
    sizes, the bitmap and one written table of the runs.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    known = items.select("item_id", "text", item_words(F.col("text")).alias("words")).withColumn("n", F.size("words")).filter("n > 0")
    lengths = known.groupBy(F.least(F.col("n"), F.lit(window)).alias("w")).agg(F.sum("n").alias("shingles")).collect()  # at most ``window`` rows
    sizes = sorted({min(r["w"], SHINGLE) for r in lengths})
    shortest = min((r["w"] for r in lengths), default=1)
    total = sum(r["shingles"] for r in lengths)
    bits = min(MAX_BITS, max(MIN_BITS, 1 << (total * BITS_PER_SHINGLE).bit_length()))
    bitmap = spark.sparkContext.broadcast(_bitmap(known, sizes, bits))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column(2))
                first, last = _runs(words, bitmap.value, sizes, shortest)
                row = np.searchsorted(words.rows, first, "right") - 1
                runs = [[] for _ in range(part.num_rows)]
                for r, a, b in zip(row.tolist(), first.tolist(), last.tolist()):
                    runs[r].append({"start": a - int(words.rows[r]), "words": words.text(a, b)})
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array(words.counts().astype(np.int64)),
                    pa.array(runs, pa.list_(pa.struct([("start", pa.int32()), ("words", pa.string())])))], ["doc_id", "text_hash", "n_words", "runs"])

    text = F.col("text").cast("string")
    marks = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("text")).mapInArrow(mark, MARKS.format(id=id_type))
    marks = scratch.cut(marks.select(row_key().alias("row"), "*"), "marks")
    texts = marks.select(F.explode("runs.words").alias("run")).groupBy("run").agg(F.count("*").alias("copies"))
    texts = scratch.cut(texts.select(row_key().alias("rid"), "run", "copies"), "runs")
    found = _verified(texts, known, window)
    per_run = found.groupBy("rid").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("ranges"), F.collect_set("item_id").alias("ids"),
                                       F.flatten(F.collect_set(F.sequence("start", F.col("end") - 1))).alias("hits"))
    # a small file may hold long texts: never a broadcast
    per_run = texts.select("rid", "run").hint("merge").join(per_run.withColumn("hits", F.size(F.array_distinct("hits"))), "rid").drop("rid")
    runs = marks.select("row", F.explode("runs").alias("r")).select("row", "r.start", F.col("r.words").alias("run"))
    shift = lambda s: F.struct((F.col("start") + s["start"]).alias("start"), (F.col("start") + s["end"]).alias("end"))
    per_doc = (runs.hint("merge").join(per_run.hint("merge"), "run").select("row", "hits", "ids", F.transform("ranges", shift).alias("ranges")).groupBy("row")
               .agg(F.sum("hits").alias("n_hit"), F.array_distinct(F.flatten(F.collect_list("ids"))).alias("items"), F.array_sort(F.flatten(F.collect_list("ranges"))).alias("windows")))
    id_array = f"array<{items.schema['item_id'].dataType.simpleString()}>"
    return marks.join(per_doc, "row", "left").select(
        "doc_id", "text_hash", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast(id_array)).alias("items"),
        F.coalesce("windows", F.array().cast("array<struct<start:int,end:int>>")).alias("windows"))


def _verified(runs: DataFrame, known: DataFrame, window: int) -> DataFrame:
    """(rid, start, end, item_id) of every window that occurs in a run; ``runs`` has rid, run and copies, ``known`` item_id, words, n.

    A shingle travels with its neighbourhood of at most twice the window, not
    with the run's or the item's whole text, so that a long copied passage is
    shuffled in proportion to its length.
    """
    def shingled(df: DataFrame, size: Column, name: str, begin, *keep: str) -> DataFrame:
        """One row per shingle: its position (from 0), text, and the words from ``begin`` of the position on."""
        parts = F.transform(F.sequence(F.lit(0), F.size("words") - size), lambda i: F.struct(
            F.array_join(F.slice(F.col("words"), i + 1, size), " ").alias("key"), F.slice(F.col("words"), begin(i) + 1, F.lit(2 * window)).alias("near")))
        return df.select(*keep, F.posexplode(F.when(F.size("words") >= size, parts)).alias(name, "t")).select(*keep, name, "t.key", "t.near")

    sizes = F.array(*[F.lit(k) for k in range(1, SHINGLE + 1)])
    reach = window - 1
    split = runs.select("rid", "copies", F.split("run", " ").alias("words")).select("*", F.size("words").alias("run_words"), F.explode(sizes).alias("k"))
    tokens = shingled(split, F.col("k"), "p", lambda i: F.greatest(i - reach, F.lit(0)), "rid", "copies", "k", "run_words")
    known_items = known.withColumn("k", F.least(F.col("n"), F.lit(SHINGLE))).withColumn("w", F.least(F.col("n"), F.lit(window)))
    base = lambda q: F.greatest(q + F.col("k") - F.col("w"), F.lit(0))
    item_tokens = shingled(known_items, F.col("k"), "q", base, "item_id", "n", "k", "w")
    wanted = item_tokens.select("key", "k").distinct()
    tokens = tokens.join(wanted, ["key", "k"], "left_semi")
    rarity = tokens.groupBy("key", "k").agg(F.sum("copies").alias("freq"))
    # every window (from word s) with each of its shingles; windows with a shingle that no document has cannot occur
    starts = F.sequence(F.greatest(F.col("q") + F.col("k") - F.col("w"), F.lit(0)), F.least(F.col("q"), F.col("n") - F.col("w")))
    in_window = item_tokens.join(rarity, ["key", "k"]).select("item_id", "near", "w", "k", "q", "key", "freq", F.explode(starts).alias("s"))
    in_window = in_window.withColumn("text", F.array_join(F.slice(F.col("near"), F.col("s") - base(F.col("q")) + 1, F.col("w")), " "))
    rarest = F.min(F.struct("freq", "key", (F.col("q") - F.col("s")).alias("offset")))
    prefix = (in_window.select("item_id", "w", "k", "text", "freq", "key", "q", "s").groupBy("item_id", "text", "w", "k", "s")
              .agg(rarest.alias("t"), F.countDistinct("q").alias("seen")).filter("seen = w - k + 1")
              .groupBy("text", "w", "k", F.col("t.key").alias("key"), F.col("t.offset").alias("offset")).agg(F.collect_set("item_id").alias("ids")))
    a = F.col("p") - F.col("offset")
    ahead = F.col("p") - F.greatest(F.col("p") - reach, F.lit(0))
    candidates = tokens.join(prefix, ["key", "k"]).filter((a >= 0) & (a + F.col("w") <= F.col("run_words")))
    same = F.array_join(F.slice(F.col("near"), F.greatest(ahead - F.col("offset"), F.lit(0)) + 1, F.col("w")), " ") == F.col("text")
    return candidates.filter(same).select("rid", a.alias("start"), (a + F.col("w")).alias("end"), F.explode_outer("ids").alias("item_id"))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """``docs`` without the rows that hold a word of an occurring item window; columns unchanged.

    A row goes by its doc_id and text, so of two rows with one doc_id only the
    contaminated text goes.
    """
    bad_id, bad_hash = fresh("bad_id", docs.columns), fresh("bad_hash", docs.columns)
    bad = find_windows(docs, items, window).filter("n_hit > 0").select(F.col("doc_id").alias(bad_id), F.col("text_hash").alias(bad_hash)).distinct()
    same = docs["doc_id"].eqNullSafe(F.col(bad_id)) & (F.xxhash64(docs["text"].cast("string")) == F.col(bad_hash))
    return docs.join(bad, same, "left_anti")
