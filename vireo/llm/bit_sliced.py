"""Exact top-k inner products with a bit-sliced index.

Vectors are quantised to integers and stored by block as bit slices: one
bitmap per dimension and bit, over the rows of the block.  A query's scores
are sums of slices, made with bitmap adders for many queries at once; the best
rows are read off from the most significant slice downward, and rows that tie
at the boundary are resolved by id.  Blocks keep their k best and the k best
of those are the result, so the answer is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vireo.llm.common import Scratch

#: Rows of an index block and queries of a chunk: bounds of one unit of work.
BLOCK_ROWS, CHUNK_QUERIES = 4096, 128
#: Dimensions whose sums are added at once, 2^GROUP of them.
GROUP = 4
#: Queries that are added at once: their slices stay in the processor's cache.
PIECE = 64
#: Blocks and chunks (on average) that meet in a task.
TASK_BLOCKS, TASK_CHUNKS = 8, 64
_ONE = np.uint64(1)


def quantise(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, as long; null if the vector is null or holds a null or non-finite component."""
    x = F.transform(vector, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(vector.isNotNull() & ~bad, F.transform(x, lambda v: F.floor(v * scale)))


def pack(bits: np.ndarray) -> np.ndarray:
    """The last axis of booleans as 64-bit words (row r is bit r % 64 of word r // 64)."""
    n = bits.shape[-1]
    padded = np.zeros((*bits.shape[:-1], -(-n // 64) * 64), bool)
    padded[..., :n] = bits
    return np.packbits(padded, axis=-1, bitorder="little").view(np.uint64)


class Slices:
    """Bit slices of a block: value = low + sum of 2^b * slice b, per dimension."""

    def __init__(self, values: np.ndarray):
        self.rows, dims = values.shape
        self.sums: tuple | None = None
        self.low = values.min(axis=0)
        self.slices: list[np.ndarray] = []
        for d in range(dims):
            rest = (values[:, d] - self.low[d]).astype(np.uint64)
            width = int(rest.max()).bit_length()
            self.slices.append(pack(np.stack([(rest >> np.uint64(b)) & _ONE == 1 for b in range(width)])) if width else np.empty((0, -(-self.rows // 64)), np.uint64))

    def packed(self) -> tuple[bytes, bytes, bytes]:
        """(low, slices of each dimension, all slices): what ``unpacked`` reads."""
        return self.low.astype(np.int64).tobytes(), np.array([len(x) for x in self.slices], np.int8).tobytes(), b"".join(x.tobytes() for x in self.slices)

    @classmethod
    def unpacked(cls, rows: int, low: bytes, widths: bytes, planes: bytes) -> Slices:
        self = cls.__new__(cls)
        self.rows, self.low, self.sums = rows, np.frombuffer(low, np.int64), None
        every = np.frombuffer(planes, np.uint64).reshape(-1, -(-rows // 64))
        self.slices = np.split(every, np.cumsum(np.frombuffer(widths, np.int8), dtype=np.int64)[:-1])
        return self

    def _sums(self) -> tuple[list[tuple[list, int]], list, int]:
        """(tables, rest, top): for each GROUP dimensions the sums of each subset of them, as planes over subset and row; top - the sum of all, as planes over the row."""
        tables, rest, top = [], [], 0
        for first in range(0, len(self.slices), GROUP):
            table, most, subsets = [], 0, 1
            for planes in self.slices[first:first + GROUP]:
                most += (1 << len(planes)) - 1
                more = _add(table, [p[None, :] for p in planes], most)
                table += [None] * (len(more) - len(table))
                table = [np.concatenate([np.zeros_like(y, shape=(subsets, y.shape[-1])) if x is None else x, np.broadcast_to(y, (subsets, y.shape[-1]))]) for x, y in zip(table, more)]
                subsets *= 2
                top += (1 << len(planes)) - 1
                rest = _add(rest, [~p for p in planes], top)
            tables.append((table, most))
        return tables, rest, top

    def scores(self, queries: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """(slices, base): the score of query q and row r is base[q] + sum of 2^b * bit r of slices[b][q].

        Weights are made positive by a power of two, 2^m: w*v = (w + 2^m)*v + 2^m*(top-v) - 2^m*top.
        For each bit of the weights, a group's part is one of the sums of its dimensions.
        """
        if self.sums is None:
            self.sums = self._sums()
        tables, rest, top = self.sums
        m = int(np.abs(queries).max(initial=0)).bit_length()
        weights = queries.astype(np.uint64) + np.uint64(1 << m)
        most = sum(upto for _, upto in tables) * ((2 << m) - 1) + (top << m)
        total = [np.zeros((len(queries), -(-self.rows // 64)), np.uint64) for _ in range(most.bit_length())]
        for at in range(0, len(queries), PIECE):
            for plane, part in zip(total, self._total(tables, weights[at:at + PIECE], m, rest, most)):
                if part is not None:
                    plane[at:at + PIECE] = part
        off = (top << m) % (1 << 64)  # scores fit 64 bits, where sums wrap around
        return total, ((queries @ self.low).astype(np.uint64) - np.uint64(off)).astype(np.int64)

    @staticmethod
    def _total(tables: list[tuple[list, int]], weights: np.ndarray, m: int, rest: list, most: int) -> list:
        total: list = []
        for b in reversed(range(m + 1)):
            bits = ((weights >> np.uint64(b)) & _ONE).astype(np.intp)
            held: list[tuple[int, list, int]] = []  # sums of 1, 2, 4 ... groups
            for g, (table, upto) in enumerate(tables):
                own = bits[:, GROUP * g:GROUP * (g + 1)]
                subset = own @ (1 << np.arange(own.shape[1]))
                held.append((1, [plane.take(subset, axis=0) for plane in table], upto))
                while len(held) > 1 and (held[-1][0] == held[-2][0] or g == len(tables) - 1):
                    (i, x, j), (k, y, n) = held.pop(), held.pop()
                    held.append((i + k, _add(x, y, j + n), j + n))
            total = _add([None, *total], held[0][1] if held else [], most)
        return _add(total, [None] * m + rest, most)


def _add(x: list, y: list, most: int) -> list:
    """The planes of two sums' sum, which is ``most`` at most; None is a plane without a bit."""
    out, carry = [], None
    for j in range(min(max(len(x), len(y)) + 1, most.bit_length())):
        held = [p[j] for p in (x, y) if j < len(p) and p[j] is not None] + [carry] * (carry is not None)
        if len(held) < 2:
            out.append(held[0] if held else None)
            carry = None
        elif len(held) == 2:
            out.append(held[0] ^ held[1])
            carry = held[0] & held[1]
        else:
            half = held[0] ^ held[1]
            out.append(half ^ carry)
            half &= carry
            half |= held[0] & held[1]
            carry = half
    return out


def select_top(total: list[np.ndarray], allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(sure, tied) bitmaps per query: rows above the boundary, and the rows equal at it; from the top slice downward."""
    sure, tied = np.zeros_like(allowed), allowed.copy()
    for plane in reversed(total):
        trial = sure | (tied & plane)
        count = np.bitwise_count(trial).sum(axis=1)
        many, few = (count > k)[:, None], (count < k)[:, None]
        exact = ~many & ~few
        sure = np.where(few | exact, trial, sure)
        tied = np.where(many, tied & plane, np.where(few, tied & ~plane, np.uint64(0)))
    return sure, tied


def _places(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) of the bits, in their order."""
    return np.nonzero(np.unpackbits(words.view(np.uint8), axis=1, bitorder="little"))


def top_of_block(index: Slices, ids: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query_id, id, score): the k best rows of a block (ids ascending) for every query, other rows' ids only; ties go to smaller ids."""
    total, base = index.scores(queries)
    allowed = pack(ids[None, :] != query_ids[:, None])
    sure, tied = select_top(total, allowed, k)
    q, row = _places(sure)
    left = k - np.bincount(q, minlength=len(query_ids))
    maybe, at = _places(tied)
    nth = np.arange(len(maybe)) - np.searchsorted(maybe, maybe)
    more = nth < left[maybe]
    q, row = np.r_[q, maybe[more]], np.r_[row, at[more]]
    score = base[q]
    for b, plane in enumerate(total):
        score += ((plane[q, row >> 6] >> (row & 63).astype(np.uint64)) & _ONE).astype(np.int64) << b
    return query_ids[q], ids[row], score


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, ident: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(query_id, rank, <ident>, score): each query's k highest inner products of quantised vectors.

    Candidates are all rows of ``vectors`` whose id is not the query's own;
    ties go to the smaller id, and fewer than k candidates give fewer rows.
    Vectors that are null or hold null or non-finite components, null ids, and
    vectors of another length than the query take no part.  Equal ids are
    separate rows; a query id with several vectors gets the k best over all of
    them.  Scores must fit 64 bits.  Empty tables give an empty result.

    The index is written once, a row of bit slices per block of BLOCK_ROWS
    vectors at most (on average; blocks are dealt by position).  Queries are dealt into chunks and every chunk meets every
    block: a fixed query set against all rows.  They meet group by
    group through a shuffle, which has a copy of a chunk for TASK_BLOCKS blocks
    and a copy of a block for TASK_CHUNKS chunks; nothing goes through the driver.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)

    def usable(df: DataFrame) -> DataFrame:
        return df.select(F.col(ident).cast("long").alias("id"), quantise(F.col(vector), scale).alias("v")).filter("id is not null and v is not null and size(v) > 0")

    rows = usable(vectors).withColumn("dims", F.size("v"))
    blocks = max(1, -(-rows.count() // BLOCK_ROWS))
    asked = usable(queries).distinct().withColumn("dims", F.size("v"))
    chunks = max(1, -(-asked.count() // CHUNK_QUERIES))
    # dealt by position, so that no id or vector, however frequent, fills a block
    dealt = rows.withColumn("block", F.pmod(F.monotonically_increasing_id(), F.lit(blocks)))

    def gather(pdf: pd.DataFrame) -> tuple[bytes, np.ndarray]:
        pdf = pdf.sort_values("id", kind="stable")
        return pdf["id"].to_numpy(np.int64).tobytes(), np.stack(pdf["v"].to_numpy()).astype(np.int64)

    def sliced(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        ids, values = gather(pdf)
        low, widths, planes = Slices(values).packed()
        return pd.DataFrame({"block": [key[0]], "dims": [key[1]], "ids": [ids], "low": [low], "widths": [widths], "planes": [planes]})

    def chunked(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        ids, values = gather(pdf)
        return pd.DataFrame({"dims": [key[1]], "query_ids": [ids], "query_vals": [values.tobytes()]})

    index = scratch.cut(dealt.groupBy("block", "dims").applyInPandas(sliced, "block long, dims int, ids binary, low binary, widths binary, planes binary"), "index")
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id", F.lit(13)), F.lit(chunks)))
    sent = scratch.cut(asked.groupBy("block", "dims").applyInPandas(chunked, "dims int, query_ids binary, query_vals binary"), "chunks")
    # groups of blocks meet groups of chunks: few copies of either, merged by key and never broadcast
    lots, cells = -(-blocks // TASK_BLOCKS), -(-chunks // TASK_CHUNKS)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    sent = sent.withColumn("cell", F.pmod(F.xxhash64("query_ids"), F.lit(cells))).withColumn("lot", every(lots))
    units = index.withColumn("lot", F.pmod("block", F.lit(lots))).withColumn("cell", every(cells)).join(sent.hint("merge"), ["lot", "cell", "dims"])

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: tuple | None = None
        for pdf in batches:
            for block, dims, ids, low, widths, planes, qids, qvals in zip(*(pdf[c] for c in ("block", "dims", "ids", "low", "widths", "planes", "query_ids", "query_vals"))):
                if held is None or held[0] != (block, dims):
                    own = np.frombuffer(ids, np.int64)
                    held = (block, dims), own, Slices.unpacked(len(own), low, widths, planes)
                found = top_of_block(held[2], held[1], np.frombuffer(qids, np.int64), np.frombuffer(qvals, np.int64).reshape(-1, dims), k)
                yield pd.DataFrame(dict(zip(("query_id", "id", "score"), found)))

    local = units.mapInPandas(answer, "query_id long, id long, score long")
    return _best(local, k).select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(ident), "score")


def _best(local: DataFrame, k: int) -> DataFrame:
    """The k best of each query, of at most k rows per block; tasks keep k rows of a query before they are shuffled."""
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return local.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
