"""Phrase collocations by top-order marginalisation.

Only the longest windows are counted: one per word, of ``longest`` words or
fewer at the end of a piece (the rest of the window is padding).  A ROLLUP
over the window's columns then sums the counts of all shorter prefixes, for
every phrase starts exactly one window at each of its occurrences.  Equal
windows of a slice are counted together first (they are told apart by 128
bits), so that a hot phrase is a row per slice before anything is shuffled.  Scores,
the removal of phrases inside longer ones and the ranking work on frequent
phrases alone: a phrase is at most as frequent as each of its parts, so no
count that a score needs is below ``least``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vireo.llm.common import Scratch, slices
from vireo.llm.words import LOWER, mix, text_bytes

#: Counts below 10^15 keep scale * a * a and l * r within a decimal's 38 digits.
COUNT = "decimal(15,0)"
#: Bytes of text whose windows are counted together before they are shuffled.
SLICE = 1 << 19
#: Parts of a group that are ranked side by side.
PARTS = 64
BREAK = np.isin(np.arange(256), list(b".,;:!?\x0a\x0b\x0c\x0d"))
BLANK = np.isin(np.arange(256), list(b" \t"))
_CODE = np.random.default_rng(11).integers(1, 1 << 63, (2, 256), dtype=np.uint64)[:, LOWER]
_BASE, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _names(data: np.ndarray, size: np.ndarray, code: np.ndarray) -> np.ndarray:
    """A 64-bit name of each word; ``data`` holds them without gaps."""
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    powers = np.full(int(size.max()) + 1, _BASE)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    return mix(np.add.reduceat(code[data] * powers[at], np.cumsum(size) - size) + size.astype(np.uint64))


def _windows(longest: int):
    """Task body: (grp, window, n): the windows that start at each word, equal ones of a slice counted together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                data, offsets = text_bytes(batch.column("text"))
                data = LOWER[data]
                stop = BREAK[data]
                inside = ~(stop | BLANK[data])
                edge = np.zeros(len(data) + 1, bool)
                edge[offsets] = True
                begin, end = inside.copy(), inside.copy()
                begin[1:] &= ~inside[:-1] | edge[1:-1]
                end[:-1] &= ~inside[1:] | edge[1:-1]
                first, size = np.flatnonzero(begin), np.flatnonzero(end) + 1
                size = size - first
                n = len(first)
                if not n:
                    continue
                piece = np.cumsum(stop | edge[:-1])[first]
                row = np.searchsorted(offsets, first, "right") - 1
                groups = batch.column("grp").dictionary_encode()
                group = groups.indices.to_numpy()[row]
                words = data[inside]
                ends = np.zeros(n + 2, np.int32)
                np.cumsum(size, out=ends[1:-1])
                ends[-1] = ends[-2]  # word n is the padding
                columns = [np.arange(n)]
                for k in range(1, longest):
                    same = np.zeros(n, bool)
                    same[:-k] = piece[k:] == piece[:-k]
                    columns.append(np.where(same, np.arange(n) + k, n))
                names = []
                for code in _CODE:
                    word = np.append(_names(words, size, code), np.uint64(0))
                    name = mix(group.astype(np.uint64) + np.uint64(1))
                    for c in columns:
                        name = mix(name * _STEP + word[c])
                    names.append(name)
                order = np.argsort(names[0])
                new = np.flatnonzero(np.r_[True, (names[0][order][1:] != names[0][order][:-1]) | (names[1][order][1:] != names[1][order][:-1])])
                one = order[new]
                # a window's bytes: from its first word to its last that is no padding, each word followed by a blank
                last = np.max([np.where(c < n, c, -1) for c in columns], axis=0)[one]
                long = ends[last + 1] - ends[one] + last - one
                at = np.arange(int(long.sum())) - np.repeat(np.cumsum(long) - long, long)
                spaced = np.insert(words, ends[1:-1], 32)
                text = spaced[at + np.repeat(ends[one] + one, long)]
                stops = np.zeros(len(one) + 1, np.int32)
                np.cumsum(long, out=stops[1:])
                strings = pa.Array.from_buffers(pa.string(), len(one), [None, pa.py_buffer(stops), pa.py_buffer(text)])
                yield pa.RecordBatch.from_pydict({"grp": groups.dictionary.take(pa.array(group[one])), "window": strings, "n": pa.array(np.diff(np.r_[new, n]))})
    return run


def counts(docs: DataFrame, scratch: Scratch, text: str, group: Column, longest: int, least: int) -> DataFrame:
    """(grp, len, phrase, f) of all phrases of 1 .. ``longest`` words that occur ``least`` times, and with len 0 every group's number of words."""
    names = [f"w{k + 1}" for k in range(longest)]
    schema = T.StructType([T.StructField("grp", T.StringType()), T.StructField("window", T.StringType()), T.StructField("n", T.LongType())])
    top = docs.select(group.alias("grp"), F.col(text).alias("text")).filter("text is not null").mapInArrow(_windows(longest), schema)
    # group and window are one string in the shuffle; no window has a tab
    top = top.groupBy(F.concat_ws("\t", "window", "grp").alias("key")).agg(F.sum("n").alias("n")).withColumn(names[-1], F.substring_index("key", "\t", 1))
    top = top.withColumn("grp", F.substr(F.col("key"), F.length(names[-1]) + 2))
    for c in names[:-1]:  # the window's columns, empty where it is padded
        top = top.withColumn(c, F.substring_index(names[-1], " ", 1))
        top = top.withColumn(names[-1], F.substr(F.col(names[-1]), F.length(c) + 2))
    top = top.select("grp", *names, "n")
    top = scratch.cut(top, "windows")
    scratch.release()
    whole = top.filter((F.col("n") >= least) & (F.col(names[-1]) != "")).select("grp", F.lit(longest).alias("len"), F.concat_ws(" ", *names).alias("phrase"), F.col("n").alias("f"))
    shorter = ", ".join(names[:-1])
    sums = docs.sparkSession.sql(f"SELECT grp, {shorter}, sum(n) AS f, grouping_id(grp, {shorter}) AS gid FROM {{top}} GROUP BY grp, ROLLUP({shorter})", top=top)
    # of the rollup's grouping id one bit after another is set from the right; padding is no word
    size = F.lit(longest - 1) - F.bit_count("gid")
    last = F.element_at(F.array(F.lit("?"), *names[:-1]), size + 1)
    sums = sums.withColumn("len", size).filter((F.col("f") >= least) | (F.col("len") == 0)).filter((F.col("len") == 0) | (last != ""))
    parts = sums.select("grp", "len", F.concat_ws(" ", *names[:-1]).alias("phrase"), "f")
    return scratch.cut(whole.unionByName(parts), "phrases")


def _cuts(words: Column, length: Column) -> Column:
    """(k, first part, rest) of every cut of a phrase."""
    part = lambda a, n: F.array_join(F.slice(words, a, n), " ")
    return F.transform(F.sequence(F.lit(1), length - 1), lambda k: F.struct(k.alias("k"), part(F.lit(1), k).alias("left"), part(k + 1, length - k).alias("right")))


def collocations(docs: DataFrame, text: str = "text", group: str = "lang", unknown: str = "und", longest: int = 3, least: int = 10,
                 inside: int = 50, scale: int = 1000000, top: int = 2000) -> DataFrame:
    """(group, rank, phrase, a, l, r, n, score): the best ``top`` phrases of 2 .. ``longest`` words of each group.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends,
    and pieces into words at blanks and tabs.  ``a`` is a phrase's number of
    occurrences, overlaps included; the cut with the lowest
    floor(scale * a * a / (l * r)) counts, the first of equal ones, with l and
    r the counts of its two parts; n is the group's number of words.  Phrases
    with a < ``least`` are none; a phrase inside a longer one (dropped or not)
    that has ``inside`` percent of its occurrences is dropped.  Ranks go by
    score and a, descending, then by the phrase's bytes.

    Null texts are empty, null groups are ``unknown``; repeated rows count
    each time, other columns are ignored, and an empty table has no phrase.
    Arithmetic is exact for counts below 10^15.  Jobs run when it is called.
    """
    if longest < 2:
        raise ValueError("a phrase has two words at least")
    scratch = Scratch(docs.sparkSession)
    found = counts(docs, scratch, text, F.coalesce(F.col(group).cast("string"), F.lit(unknown)), longest, least)
    phrases = found.filter("len >= 1").select("grp", "len", "phrase", "f")
    candidates = phrases.filter("len >= 2")
    words = F.split("phrase", " ")
    cut = candidates.select("grp", "len", "phrase", F.col("f").alias("a"), F.explode(_cuts(words, F.col("len"))).alias("c")).select("grp", "len", "phrase", "a", "c.*")
    part = lambda name, count: phrases.select("grp", F.col("phrase").alias(name), F.col("f").alias(count))
    cut = cut.join(part("left", "l"), ["grp", "left"]).join(part("right", "r"), ["grp", "right"])
    a, l, r = (F.col(c).cast(COUNT) for c in ("a", "l", "r"))
    score = F.call_function("div", F.lit(scale).cast("decimal(7,0)") * (a * a), l * r).cast("long")
    best = cut.groupBy("grp", "phrase", "len", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("b"))
    # the most frequent longer phrase around each phrase
    words, size = F.split("phrase", " "), F.col("len")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.array_join(F.slice(words, i, n), " "))))
    around = candidates.filter("len > 2").select("grp", "f", F.explode(inner).alias("phrase")).groupBy("grp", "phrase").agg(F.max("f").alias("longer"))
    kept = best.join(around, ["grp", "phrase"], "left").filter(F.coalesce(F.col("longer"), F.lit(0)).cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * inside)
    # the best of each part of a group first, so that no task ranks a whole group
    best_first = [F.col("b.score").desc(), F.col("a").desc(), F.col("phrase")]
    dealt = kept.withColumn("rank", F.row_number().over(Window.partitionBy("grp", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*best_first))).filter(F.col("rank") <= top)
    ranked = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("grp").orderBy(*best_first))).filter(F.col("rank") <= top)
    sizes = found.filter("len = 0").select("grp", F.col("f").alias("n"))
    out = ranked.join(sizes, "grp")
    return out.select(F.col("grp").alias(group), F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("b.l").alias("l"), F.col("b.r").alias("r"), "n", F.col("b.score").alias("score"))
