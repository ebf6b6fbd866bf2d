"""Byte-level BPE with a rank file, encoded and decoded.

Texts are gathered into blocks of bounded size.  A block's pre-tokens become
its distinct words and, per document, positions in that list.  Spark's
higher-order functions then fold the ranked merges over the byte ids of every
distinct word; the rank map travels with the block as literal data.  Nothing
is shuffled and no vocabulary of the corpus is built.

The most frequent words of a bounded sample of documents are folded first and
shared, so that blocks need not fold them again.  That only saves work: a word
that is not among them is folded in its block.

Spark looks a map's key up by walking the map, so the rank map is dealt into
many small maps by the key's remainder.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text in a block (one document at least).
BLOCK_BYTES = 8 << 20
#: Documents sampled for the shared words, the longest of them, and the words shared.
SAMPLE_ROWS, SAMPLE_BYTES, SHARED_WORDS = 16384, 1 << 20, 300_000
#: Words of more bytes are merged with a heap in the task: a fold over arrays costs the square of their length.
LONG_WORD = 512
#: Maps that the rank map is dealt into (a prime), bits of an id, and the rank of a pair that does not merge.
MAPS, BITS = 65537, 21
NONE = (1 << 31) - 1
#: White space as Unicode's White_Space has it; Python's own \s also takes U+001C to U+001F.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Characters of which the standard library's letter and digit classes say the same as Unicode's L and N.
PLAIN = re.compile("[\x00-\x7f\xc0-\xd6\xd8-\xf6\xf8-\u024f\u2018-\u201f]*")


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """A function that splits a text by ``pattern``, white space as in SPACE.

    Plain texts take the standard library's matcher, which is faster; its
    classes for letters and digits are those of the pattern there.
    """
    spaced = pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]")
    exact = regex.compile(spaced).findall
    if pattern.count(r"\p") != 4 or r"[^\s\p{L}\p{N}]" not in pattern:
        return exact
    plain = spaced.replace(rf"[^{SPACE}\p{{L}}\p{{N}}]", rf"(?:[^{SPACE}\w]|_)").replace(r"\p{L}", r"[^\W\d_]").replace(r"\p{N}", r"\d")
    quick = re.compile(plain).findall
    return lambda text: quick(text) if PLAIN.fullmatch(text) else exact(text)


@dataclass(frozen=True)
class Ranks:
    """A vocabulary: token bytes by rank, and the rank that two neighbouring ids merge into."""

    tokens: dict[bytes, int]
    pieces: list[bytes]
    pairs: dict[tuple[int, int], int]
    byte_ids: list[int]

    @classmethod
    def load(cls, path: str) -> Ranks:
        """From a file of lines ``base64(token) rank``; every byte must be a token."""
        with open(path, "rb") as f:
            tokens = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        pieces = [b""] * (max(tokens.values()) + 1)
        for token, rank in tokens.items():
            pieces[rank] = token
        pairs = {}
        for token, rank in tokens.items():
            for i in range(1, len(token)):
                left, right = tokens.get(token[:i]), tokens.get(token[i:])
                if left is not None and right is not None:
                    pairs[left, right] = rank
        return cls(tokens, pieces, pairs, [tokens[bytes([b])] for b in range(256)])

    def maps(self) -> pa.Array:
        """The pair ranks as one array of MAPS small maps."""
        dealt: list[list[tuple[int, int]]] = [[] for _ in range(MAPS)]
        for (left, right), rank in self.pairs.items():
            key = (left << BITS) + right
            dealt[key % MAPS].append((key, rank))
        return pa.array([dealt], pa.list_(pa.map_(pa.int64(), pa.int32())))

    def merge_long(self, word: bytes) -> list[int]:
        """The ids of one word by a heap of candidate merges: least rank first, then the leftmost."""
        ids: list[int | None] = [self.byte_ids[b] for b in word]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(rank, i, ids[i], ids[i + 1]) for i in range(len(ids) - 1) if (rank := self.pairs.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= len(ids) or ids[j] != right:
                continue
            ids[i], ids[j], after[i] = rank, None, after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < len(ids) and (new := self.pairs.get((ids[a], ids[b]))) is not None:
                    heapq.heappush(heap, (new, a, ids[a], ids[b]))
        return [x for x in ids if x is not None]


def merge_fold(word: Column, maps: Column) -> Column:
    """The ids that ranked merges make of ``word`` (array of byte ids): one merge a step, least rank first, then the leftmost.

    The fold's state has a number per token: the rank of the pair that it
    makes with the next, above its id.  The least number is then the next pair
    to merge; its rank is the id that the pair becomes.  A merge puts one
    number for two and renews the one before.
    """
    def rank(left: Column, right: Column) -> Column:
        key = F.shiftleft(left, BITS) + right
        return F.coalesce(F.try_element_at(F.get(maps, F.pmod(key, F.lit(MAPS)).cast("int")), key), F.lit(NONE)).cast("long")

    def number(ident: Column, after: Column) -> Column:
        """``after`` is the next token's id, or null at the end."""
        return F.shiftleft(F.when(after.isNull(), F.lit(NONE).cast("long")).otherwise(rank(ident, after)), BITS) + ident

    def ident(state: Column, at: Column) -> Column:
        return F.get(state, at).bitwiseAND(F.lit((1 << BITS) - 1))

    def let(value: Column, body) -> Column:
        """``body(value)`` with the value computed once."""
        return F.get(F.transform(F.array(value), body), F.lit(0))

    def merged(state: Column, low: Column) -> Column:
        new = F.shiftright(low, BITS)

        def at(p: Column) -> Column:
            own = number(new, ident(state, p + 1))
            before = ident(state, p - 2)
            pair = F.when(p == 1, F.array(own)).otherwise(F.array(number(before, new), own))
            return F.concat(F.slice(state, F.lit(1), F.greatest(p - 2, F.lit(0))), pair, F.slice(state, p + 2, F.size(state)))

        return let(F.array_position(state, low).cast("int"), at)

    def step(state: Column, _: Column) -> Column:
        return let(F.array_min(state), lambda low: F.when(low < F.lit(NONE << BITS), merged(state, low)).otherwise(state))

    start = F.transform(word, lambda x, i: number(x.cast("long"), F.get(word, i + 1).cast("long")))
    folded = F.aggregate(F.slice(word, 2, F.greatest(F.size(word), F.lit(1))), start, step)
    return F.transform(folded, lambda x: x.bitwiseAND(F.lit((1 << BITS) - 1)).cast("int"))


def decode_pieces(ids: Column, pieces: Column) -> Column:
    """The bytes of ``ids``: binary pieces (an array by rank) put one after the other."""
    return F.array_join(F.transform(ids, lambda i: F.get(pieces, i).cast("string")), "").cast("binary")


class _WordIds(dict):
    """Word to number; a new word gets the next."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


@dataclass(frozen=True)
class Shared:
    """Words already encoded: their ids and bytes end to end, and where each begins."""

    words: list[str]
    ids: np.ndarray
    id_ends: np.ndarray
    data: np.ndarray
    data_ends: np.ndarray


NO_WORDS = Shared([], np.empty(0, "<u4"), np.zeros(1, np.int64), np.empty(0, np.uint8), np.zeros(1, np.int64))


def _picked(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The runs ``at`` of ``values``, end to end; run k has sizes[k] values from starts[k] on."""
    n = sizes[at]
    return values[np.repeat(starts[at] - np.cumsum(n) + n, n) + np.arange(n.sum())]


def _encode(source: DataFrame, ranks: Ranks, pattern: str, shared: Shared) -> DataFrame:
    """(id, ids, decoded) of ``source`` (id, text without nulls)."""
    context = source.sparkSession.sparkContext
    id_type = source.schema["id"].dataType.simpleString()
    light = context.broadcast((ranks.maps(), pa.array([ranks.pieces], pa.list_(pa.binary())), np.array(ranks.byte_ids, np.int32), shared.words))
    heavy, known = context.broadcast(ranks), context.broadcast(shared)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps, pieces, byte_ids, common = light.value
        find, first = splitter(pattern), len(common)
        words = _WordIds(zip(common, range(first)))
        idents, tokens, held = [], [], 0
        kind = pa.null()

        def block() -> pa.RecordBatch:
            new = []
            while len(words) > first:
                new.append(words.popitem()[0])  # the last word first
            raw = [w.encode() for w in reversed(new)]
            long = {i: heavy.value.merge_long(w) for i, w in enumerate(raw) if len(w) > LONG_WORD}
            short = [b"" if i in long else w for i, w in enumerate(raw)] if long else raw
            ends = np.cumsum([0, *map(len, short)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(byte_ids[np.frombuffer(b"".join(short), np.uint8)]))
            apart = pa.array([[{"at": i, "ids": ids} for i, ids in long.items()]], pa.list_(pa.struct([("at", pa.int32()), ("ids", pa.list_(pa.int32()))])))
            return pa.RecordBatch.from_arrays([pa.array([idents], pa.list_(kind)), pa.array([tokens], pa.list_(pa.binary())), pa.ListArray.from_arrays(pa.array([0, len(lists)], pa.int32()), lists), apart, maps, pieces],
                                              ["idents", "tokens", "words", "long", "maps", "pieces"])

        for batch in batches:
            kind = batch.schema.types[0]
            for key, value in zip(batch.column(0), batch.column(1)):
                value = value.as_py()
                idents.append(key.as_py())
                found = find(value)
                tokens.append(np.fromiter(map(words.__getitem__, found), np.int32, len(found)).tobytes())
                held += len(value)
                if held >= BLOCK_BYTES:
                    yield block()
                    idents, tokens, held = [], [], 0
        if idents:
            yield block()

    blocks = source.mapInArrow(gather, f"idents array<{id_type}>, tokens array<binary>, words array<array<int>>, long array<struct<at:int,ids:array<int>>>, "
                                       "maps array<map<long,int>>, pieces array<binary>")
    folded = blocks.select("idents", "tokens", "pieces", "long", F.transform("words", lambda w: merge_fold(w, F.col("maps"))).alias("encoded"))
    # long words come encoded; empty words stand for them in the list
    decoded = folded.select("idents", "tokens", "encoded", F.transform("encoded", lambda w: decode_pieces(w, F.col("pieces"))).alias("decoded"),
                            F.transform("long", lambda x: F.struct(x["at"].alias("at"), x["ids"].alias("ids"), decode_pieces(x["ids"], F.col("pieces")).alias("decoded"))).alias("long"))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = known.value
        for batch in batches:
            for row in range(batch.num_rows):
                idents, tokens, encoded, pieces, long = (batch.column(i).slice(row, 1).flatten() for i in range(5))
                new_ids, new_data = encoded.flatten().to_numpy().astype("<u4"), np.frombuffer(b"".join(pieces.to_pylist()), np.uint8)
                sizes = np.asarray(pc.list_value_length(encoded), np.int64), np.asarray(pc.binary_length(pieces), np.int64)
                apart = long.to_pylist()
                ids, data = [base.ids, new_ids], [base.data, new_data]
                n_ids, n_data = np.concatenate([np.diff(base.id_ends), sizes[0]]), np.concatenate([np.diff(base.data_ends), sizes[1]])
                at_ids, at_data = np.cumsum(n_ids) - n_ids, np.cumsum(n_data) - n_data
                for x in apart:  # a long word's ids and bytes lie behind those of all others
                    at = len(base.words) + x["at"]
                    at_ids[at], n_ids[at] = sum(map(len, ids)), len(x["ids"])
                    at_data[at], n_data[at] = sum(map(len, data)), len(x["decoded"])
                    ids.append(np.array(x["ids"], "<u4"))
                    data.append(np.frombuffer(x["decoded"], np.uint8))
                ids, data = np.concatenate(ids), np.concatenate(data)
                out_ids, out_data, start, size = [], [], 0, 0
                for d, words in enumerate(tokens):
                    at = np.frombuffer(words.as_py(), np.int32)
                    out_ids.append(_picked(ids, at_ids, n_ids, at).tobytes())
                    out_data.append(_picked(data, at_data, n_data, at).tobytes())
                    size += len(out_ids[-1]) + len(out_data[-1])
                    if size > 4 << 20 or d + 1 == len(tokens):
                        yield pa.RecordBatch.from_arrays([idents.slice(start, d + 1 - start), pa.array(out_ids, pa.binary()), pa.array(out_data, pa.binary())], ["id", "ids", "decoded"])
                        out_ids, out_data, start, size = [], [], d + 1, 0

    return decoded.mapInArrow(spread, f"id {id_type}, ids binary, decoded binary")


def shared_words(source: DataFrame, ranks: Ranks, pattern: str) -> Shared:
    """The SHARED_WORDS most frequent words (ties by text) of about SAMPLE_ROWS documents, encoded.

    Rows are drawn by hash of id and text; texts over SAMPLE_BYTES are left out.
    """
    total = source.count()
    buckets = 1 << 30
    share = min(1.0, SAMPLE_ROWS / max(total, 1))
    drawn = source.filter((F.pmod(F.xxhash64("id", "text"), F.lit(buckets)) < int(share * buckets)) & (F.octet_length("text") <= SAMPLE_BYTES)).select("text").limit(2 * SAMPLE_ROWS)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = splitter(pattern)
        for batch in batches:
            counts: dict[str, int] = {}
            for text in batch.column(0):
                for word in find(text.as_py()):
                    counts[word] = counts.get(word, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["text", "n"])

    counted = drawn.mapInArrow(split, "text string, n long").groupBy("text").agg(F.sum("n").alias("n"))
    top = counted.filter(F.octet_length("text") <= LONG_WORD).orderBy(F.desc("n"), "text").limit(SHARED_WORDS)
    words = top.select(F.col("text").alias("id"), "text").repartition(24, "text")
    found = _encode(words, ranks, pattern, NO_WORDS).toArrow().combine_chunks()
    if not found.num_rows:
        return NO_WORDS

    def joined(name: str, kind: str) -> tuple[np.ndarray, np.ndarray]:
        values = found[name].to_pylist()
        return np.frombuffer(b"".join(values), kind), np.cumsum([0, *(len(x) // np.dtype(kind).itemsize for x in values)])

    return Shared(found["id"].to_pylist(), *joined("ids", "<u4"), *joined("decoded", "u1"))


def encode(docs: DataFrame, path: str, pattern: str, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(<ident>, ids, decoded) of every row: the token ids as little-endian unsigned 32-bit integers, and the bytes they decode to.

    ``path`` is a rank file and ``pattern`` splits texts into words, each
    encoded by itself; strings of special tokens are ordinary text.  Null is
    the empty text, which has no ids.  Repeated rows give repeated rows, and
    other columns are not read.  The driver reads the rank file; tasks get it
    with the function that they run.  A job that encodes the shared words runs
    when it is called.
    """
    ranks = Ranks.load(path)
    source = docs.select(F.col(ident).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return _encode(source, ranks, pattern, shared_words(source, ranks, pattern)).withColumnRenamed("id", ident)
