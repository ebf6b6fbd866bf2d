"""Language identification with error-correcting output codes.

Every language has a codeword of bits.  One binary n-gram classifier per bit
says on which side of the code a text lies, and the language whose codeword
loses least is chosen.  The classifiers are log-odds of hashed byte n-grams,
learned from counts over all labelled rows, so what the driver holds is one
row of counts per language.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo.llm.common import slices
from vireo.llm.words import LOWER, text_bytes

#: Hash buckets of n-grams.
BUCKETS = 1 << 14
#: Byte n-grams: pairs and triples, words padded with blanks.
ORDERS = (2, 3)
#: Languages the model may hold; more is an error, not a cut.
MAX_LANGUAGES = 1000
#: n-grams after which more text adds no certainty to a bit.
SATURATION = 60.0
#: Difference of the two least losses (a bit) under which a text is ambiguous.
AMBIGUOUS = 0.05
#: Bytes looked at together in a long text.
PIECE = 1 << 20
UNKNOWN = "und"

_CODES = np.arange(256)
_SYMBOL = np.where(((LOWER >= 97) & (LOWER <= 122)) | (_CODES >= 128), LOWER, 32).astype(np.uint32)


def code_matrix(languages: int, seed: int = 3) -> np.ndarray:
    """Codewords of +1/-1, a row per language: exhaustive up to five, else the best of random codes by least distance."""
    if languages <= 1:
        return np.ones((languages, 1), np.int8)
    if languages <= 5:
        rest = [c for c in itertools.product((1, -1), repeat=languages - 1) if -1 in c]
        return np.array([(1, *c) for c in rest], np.int8).T.copy()
    rng, bits, best = np.random.default_rng(seed), int(np.ceil(10 * np.log2(languages))), None
    for _ in range(50):
        code = rng.choice(np.array([-1, 1], np.int8), (languages, bits))
        close = code.astype(np.int32) @ code.T - 2 * bits * np.eye(languages, dtype=np.int32)
        split = (np.abs(code.sum(axis=0)) < languages).all()
        if split and (best is None or close.max() < best[0]):
            best = close.max(), code
    return best[1]


def _padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all rows, anything else blank, two blanks before each row and at the end; and the rows' starts."""
    n = len(offsets) - 1
    out = np.full(len(data) + 2 * (n + 1), 32, np.uint32)
    at = np.arange(len(data)) + 2 * (1 + np.repeat(np.arange(n), np.diff(offsets)))
    out[at] = _SYMBOL[data]
    return out, offsets[:-1] + 2 * np.arange(n)


def _grams(letters: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the n-gram at every position, and whether it holds a letter beside its first byte."""
    n = len(letters) - order + 1
    code, some = letters[:n].copy(), np.zeros(n, bool)
    for j in range(1, order):
        code = code << np.uint32(8) | letters[j:n + j]
        some |= letters[j:n + j] != 32
    code = (code + np.uint32(order << 24)) * np.uint32(0x9E3779B1)
    return code >> np.uint32(32 - BUCKETS.bit_length() + 1), some


def _pieces(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets): the column, long rows in parts of PIECE bytes."""
    data, offsets = text_bytes(column)
    if len(data) <= 2 * PIECE:
        yield 0, data, offsets
        return
    for r in range(len(column)):
        for a in range(int(offsets[r]), max(int(offsets[r + 1]), int(offsets[r]) + 1), PIECE):
            part = data[a:min(a + PIECE, int(offsets[r + 1]))]
            yield r, part, np.array([0, len(part)])


def _with_letters(column: pa.Array) -> np.ndarray:
    """Rows that hold a letter of any script."""
    out = np.zeros(len(column), bool)
    for r, data, offsets in _pieces(column):
        sums = np.concatenate([[0], np.cumsum(((LOWER >= 97) & (LOWER <= 122))[data])])
        out[r:r + len(offsets) - 1] |= np.diff(sums[offsets]) > 0
    for r in np.flatnonzero(~out).tolist():
        out[r] = any(c.isalpha() for c in column[r].as_py() or "")
    return out


def count_grams(labelled: DataFrame) -> dict[str, np.ndarray]:
    """n-gram counts per bucket of every language in ``labelled`` (text, lang): all rows are counted, and a row per language and bucket reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, counts in held.items():
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[at])], ["lang", "bucket", "n"])
            held.clear()

        for batch in batches:
            for part in slices(batch, "text"):
                langs = part.column(1).to_pylist()
                for r, data, offsets in _pieces(part.column(0)):
                    letters, starts = _padded(data, offsets)
                    names, code = np.unique(np.array(langs[r:r + len(offsets) - 1], object).astype(str), return_inverse=True)
                    owner = np.repeat(code, np.diff(np.append(starts, len(letters))))
                    for order in ORDERS:
                        bucket, some = _grams(letters, order)
                        flat = np.bincount(owner[:len(bucket)][some] * BUCKETS + bucket[some], minlength=len(names) * BUCKETS).reshape(len(names), BUCKETS)
                        for name, counts in zip(names.tolist(), flat):
                            held[name] = held[name] + counts if name in held else counts
                if len(held) > 64:
                    yield from flush()
        yield from flush()

    sums = labelled.select(F.col("text").cast("string").alias("text"), "lang").mapInArrow(count, "lang string, bucket int, n long")
    sums = sums.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    known = labelled.select("lang").distinct().limit(MAX_LANGUAGES + 1).count()
    if known > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: raise MAX_LANGUAGES or clean the labels")
    # a row per language, with BUCKETS entries at most
    table = sums.groupBy("lang").agg(F.collect_list("bucket").alias("buckets"), F.collect_list("n").alias("counts")).toArrow()
    rows = zip(table["lang"].to_pylist(), table["buckets"], table["counts"])
    return {lang: np.bincount(b.values.to_numpy(), weights=n.values.to_numpy(), minlength=BUCKETS) for lang, b, n in rows}


@dataclass(frozen=True)
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray  # buckets x bits


def fit(labelled: DataFrame) -> Model:
    """A classifier per bit from the n-gram counts of all rows of ``labelled`` (text, lang not null).

    A bit's weight of an n-gram is the log of its mean share in the languages
    of one side over that in the other.  Without rows the model knows no
    language; with one, it always answers that one.
    """
    counts = count_grams(labelled)
    languages = sorted(counts)
    code = code_matrix(len(languages))
    if not languages:
        return Model([], code, np.zeros((BUCKETS, 1), np.float32))
    share = np.stack([(counts[x] + 0.5) / (counts[x].sum() + 0.5 * BUCKETS) for x in languages])
    weights = np.zeros((BUCKETS, code.shape[1]), np.float32)
    for b in range(code.shape[1]):
        plus, minus = code[:, b] > 0, code[:, b] < 0
        if plus.any() and minus.any():
            weights[:, b] = np.log(share[plus].mean(axis=0)) - np.log(share[minus].mean(axis=0))
    return Model(languages, code, weights)


def margins(column: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Each row's margin per bit: mean log-odds of its n-grams, times their number up to SATURATION."""
    total, seen = np.zeros((len(column), weights.shape[1])), np.zeros(len(column))
    for r, data, offsets in _pieces(column):
        letters, starts = _padded(data, offsets)
        rows = slice(r, r + len(starts))
        for order in ORDERS:
            bucket, some = _grams(letters, order)
            picked = np.where(some, bucket, BUCKETS)
            table = np.vstack([weights, np.zeros((1, weights.shape[1]), np.float32)])
            total[rows] += np.add.reduceat(table[picked], starts, axis=0)
            seen[rows] += np.add.reduceat(some, starts, dtype=np.int64)
    return total / np.maximum(seen, 1)[:, None] * np.minimum(seen, SATURATION)[:, None]


def decode(model: Model, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(language index, score, ambiguous): the codeword of least mean logistic loss; score is its share of the softmax of minus losses."""
    side = model.code[None, :, :] * margin[:, None, :]
    loss = np.logaddexp(0, -side).mean(axis=2)
    best = loss.argmin(axis=1)
    odds = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
    least = np.sort(loss, axis=1)
    close = least[:, 1] - least[:, 0] < AMBIGUOUS if loss.shape[1] > 1 else np.zeros(len(loss), bool)
    return best, (odds.max(axis=1) / odds.sum(axis=1)), close


def predict(docs: DataFrame, model: Model, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(<ident>, lang_pred, score, ambiguous) of every row.

    Texts that are null, empty or without a letter are ``und`` with score 0
    and not ambiguous; so is every text if the model knows no language.
    Whole texts are read; repeated rows give repeated rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[ident].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                known = _with_letters(part.column(1)) & bool(m.languages)
                langs, score, close = np.full(part.num_rows, UNKNOWN, object), np.zeros(part.num_rows), np.zeros(part.num_rows, bool)
                if known.any():
                    best, s, c = decode(m, margins(part.column(1), m.weights))
                    langs[known] = np.array(m.languages, object)[best[known]]
                    score[known], close[known] = s[known], c[known]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(langs, pa.string()), pa.array(score), pa.array(close)], ["id", "lang_pred", "score", "ambiguous"])

    out = docs.select(F.col(ident).alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(apply, f"id {id_type}, lang_pred string, score double, ambiguous boolean")
    return out.withColumnRenamed("id", ident)
