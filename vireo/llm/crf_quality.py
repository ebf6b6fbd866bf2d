"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad.  Its features are those of the line itself and of
the lines beside it; neighbouring labels depend on each other.  The forward-
backward marginals of a document's lines, weighted by length, make its score.

Labels exist for documents only.  Training starts with every line labelled
like its document; then the lines of bad documents that the model finds good
are relabelled, and the model is fitted again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo.llm.common import slices
from vireo.llm.words import IS_WORD, Words, mix, text_bytes

#: Labelled documents that a fit uses, about (drawn by hash), and the bytes of the longest of them.
SAMPLE_ROWS = 4000
SAMPLE_BYTES = 1 << 20
#: Lines of a chain that advance one after the other: longer chains go in pieces that advance side by side.
PIECE = 512
#: Bytes of a text described at once, up to the next line's end.
PART = 1 << 18
#: Rounds of relabelling, gradient steps of each, and the penalty on weights.
ROUNDS, STEPS, PENALTY = 3, 120, 1e-3

_CODES = np.arange(256)
#: Byte classes counted in every line.
_CLASSES = np.stack([
    (_CODES >= 65) & (_CODES <= 90),
    (_CODES >= 97) & (_CODES <= 122),
    _CODES >= 128,
    (_CODES >= 48) & (_CODES <= 57),
    np.isin(_CODES, [9, 32]),
    np.isin(_CODES, list(b".,;:?'\"-()")),
    _CODES == ord("!"),
    np.isin(_CODES, list(b"|/\\<>{}[]")),
    np.isin(_CODES, list(b"#$%&*@^~=+_`")),
    (_CODES < 32) & (_CODES != 9) & (_CODES != 10) | (_CODES == 127),
])
OWN = len(_CLASSES) + 8
#: The own feature that counts a line's copies in its text.
COPIES = len(_CLASSES) + 5
#: Own features, those of both neighbours, first and last line, constant.
FEATURES = 3 * OWN + 3


def line_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of all lines, without neighbours; bytes of each line; offsets of the rows' lines).

    Lines are separated by newlines; a null or empty text is one empty line.
    """
    own, size, first, content, some = _describe(column)
    own[:, COPIES] = _copies(content, np.repeat(np.arange(len(first) - 1), np.diff(first)), some)
    return own, size, first


def _describe(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(:func:`line_features` with COPIES 0, bytes, offsets, a hash of each line's words, whether it has any)."""
    words = Words(column)
    data, offsets = words.data, words.offsets
    breaks = np.flatnonzero(data == 10)
    per_row = np.diff(np.searchsorted(breaks, offsets)) + 1
    first = np.concatenate([[0], np.cumsum(per_row)])
    starts = np.empty(first[-1], np.int64)
    ends = np.empty(first[-1], np.int64)
    starts[first[:-1]] = offsets[:-1]
    inner = np.ones(first[-1], bool)
    inner[first[:-1]] = False
    starts[inner] = breaks + 1
    ends[first[1:] - 1] = offsets[1:]
    closing = np.ones(first[-1], bool)
    closing[first[1:] - 1] = False
    ends[closing] = breaks
    size = ends - starts
    n = np.maximum(size, 1)
    kinds = _KIND[data]
    columns = []
    for c in range(len(_CLASSES)):
        sums = np.concatenate([[0], np.cumsum(kinds == c, dtype=np.int32)])
        columns.append((sums[ends] - sums[starts]) / n)
    wa, wb = np.searchsorted(words.starts, starts), np.searchsorted(words.starts, ends)
    count = wb - wa
    some = np.maximum(count, 1)
    letters = np.concatenate([[0], np.cumsum(words.ends - words.starts)])
    mean = (letters[wb] - letters[wa]) / some
    line_of = np.repeat(np.arange(len(count)), count)
    again = np.zeros(len(words.hashes) + 1, np.int32)
    if len(words.hashes) > 1:
        same = (words.hashes[1:] == words.hashes[:-1]) & (line_of[1:] == line_of[:-1])
        again[2:] = np.cumsum(same)
    order = np.lexsort((words.hashes, line_of))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (words.hashes[order][1:] != words.hashes[order][:-1]) | (line_of[order][1:] != line_of[order][:-1])
    distinct = np.bincount(line_of[order][fresh], minlength=len(count))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(words.hashes + np.uint64(1)))])
    gaps = _symbol_gaps(data, kinds, starts, ends)
    columns += [np.log1p(size) / 8, np.log1p(count) / 6, np.minimum(mean, 30) / 10, (again[wb] - again[np.minimum(wa + 1, wb)]) / some,
                1 - distinct / some, np.zeros(len(count)), (count == 0).astype(float), gaps / some]
    return np.stack(columns, axis=1).astype(np.float32), size, first, sums[wb] - sums[wa], count > 0


def _copies(content: np.ndarray, owner: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Other lines of the same text (``owner``) with the same words, up to five, as a share; 0 for lines without words."""
    _, inverse, copies = np.unique(mix(content + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_inverse=True, return_counts=True)
    return (np.minimum(copies - 1, 5) / 5).astype(np.float32)[inverse] * some


_KIND = np.full(256, 255, np.uint8)
for _i, _mask in enumerate(_CLASSES):
    _KIND[_mask] = _i


def _symbol_gaps(data: np.ndarray, kinds: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Runs of symbols (not blanks, letters, digits or sentence marks) in every line."""
    symbol = (kinds >= 6) & ~IS_WORD[data] if len(data) else np.zeros(0, bool)
    begin = symbol.copy()
    begin[1:] &= ~symbol[:-1]
    sums = np.concatenate([[0], np.cumsum(begin)])
    return sums[ends] - sums[starts]


def with_neighbours(own: np.ndarray, first: np.ndarray) -> np.ndarray:
    """FEATURES columns: a line, the one before and the one after it (zeros at the edges), edge marks and a constant."""
    n = len(own)
    at_start, at_end = np.zeros(n, bool), np.zeros(n, bool)
    at_start[first[:-1]] = True
    at_end[first[1:] - 1] = True
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:] = own[:-1]
    after[:-1] = own[1:]
    before[at_start] = 0
    after[at_end] = 0
    return np.hstack([own, before, after, at_start[:, None], at_end[:, None], np.ones((n, 1))]).astype(np.float32)


class _Chains:
    """Runs of lines laid out so that all advance together, longest first."""

    def __init__(self, start: np.ndarray, length: np.ndarray):
        self.order = np.argsort(-length, kind="stable")
        self.start, self.length = start[self.order], length[self.order]
        self.steps = int(self.length[0]) if len(length) else 0
        self.active = np.searchsorted(-self.length, -np.arange(1, self.steps + 1), "right")


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis)
    return top + np.log(np.exp(x - np.expand_dims(top, axis)).sum(axis=axis))


def _across(unary: np.ndarray, trans: np.ndarray, start: np.ndarray, length: np.ndarray, inner: np.ndarray) -> np.ndarray:
    """A 2 x 2 log weight per piece: from the label before it (for pieces that are not ``inner`` there is none) to that of its last line."""
    chains = _Chains(start, length)
    hop = np.where(inner[chains.order][:, None, None], trans, 0.0) + unary[chains.start][:, None, :]
    for t in range(1, chains.steps):
        n = chains.active[t]
        hop[:n] = _lse(hop[:n, :, :, None] + trans, 2) + unary[chains.start[:n] + t][:, None, :]
    out = np.empty_like(hop)
    out[chains.order] = hop
    return out


def _messages(unary: np.ndarray, trans: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward log messages of every line.

    All chains advance together.  A chain of more than PIECE lines is cut: the
    weights across its pieces give the messages at their edges, a step per
    piece, and the lines of all pieces then advance together too.
    """
    pieces = -(-np.diff(first) // PIECE)
    nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = np.repeat(first[:-1], pieces) + nth * PIECE
    length = np.minimum(np.repeat(first[1:], pieces) - start, PIECE)
    inner = nth > 0
    alpha, beta = unary.copy(), np.zeros(unary.shape)
    if inner.any():
        cut = np.flatnonzero(inner | np.append(inner[1:], False))
        hop = np.zeros((len(start), 2, 2))
        hop[cut] = _across(unary, trans, start[cut], length[cut], inner[cut])
        by_nth = cut[np.argsort(nth[cut], kind="stable")]
        rounds = np.split(by_nth, np.cumsum(np.bincount(nth[cut]))[:-1])[1:]
        edge, back = hop[:, 0].copy(), np.zeros((len(start), 2))
        for p in rounds:
            edge[p] = _lse(edge[p - 1][:, :, None] + hop[p], 1)
        for p in reversed(rounds):
            back[p - 1] = _lse(hop[p] + back[p][:, None, :], 2)
        later = np.flatnonzero(inner)
        alpha[start[later]] += _lse(edge[later - 1][:, :, None] + trans, 1)
        beta[start + length - 1] = back
    chains = _Chains(start, length)
    for t in range(1, chains.steps):
        at = chains.start[:chains.active[t]] + t
        alpha[at] += _lse(alpha[at - 1][:, :, None] + trans, 1)
    for t in range(chains.steps - 2, -1, -1):
        at = chains.start[:chains.active[t + 1]] + t
        beta[at] = _lse(trans + (unary[at + 1] + beta[at + 1])[:, None, :], 2)
    return alpha, beta


def marginals(unary: np.ndarray, trans: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(P(label) of every line, expected number of each transition) by forward-backward; unary has a column per label (bad, good)."""
    alpha, beta = _messages(unary, trans, first)
    total = alpha + beta
    norm = _lse(total, 1)
    inner = np.ones(len(unary), bool)
    inner[first[1:] - 1] = False
    at = np.flatnonzero(inner)
    pair = alpha[at][:, :, None] + trans + (unary[at + 1] + beta[at + 1])[:, None, :] - norm[at][:, None, None]
    return np.exp(total - norm[:, None]), np.exp(pair).sum(axis=0)


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of the label good against bad
    trans: np.ndarray    # 2 x 2
    slope: float = 1.0   # from the weighted mean of marginals to the log-odds of a good document
    shift: float = 0.0
    fitted: bool = False

    def lines(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        """P(good) of every line."""
        return self.good(((features - self.mean) / self.scale) @ self.weights, first)

    def good(self, z: np.ndarray, first: np.ndarray) -> np.ndarray:
        """P(good) of every line from its evidence, the log-odds of good without neighbouring labels."""
        alpha, beta = _messages(np.stack([np.zeros_like(z), z], axis=1), self.trans, first)
        alpha += beta
        return 1 / (1 + np.exp(np.clip(alpha[:, 0] - alpha[:, 1], -700, 700)))

    def evidence(self, parts: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Evidence of every line from ``parts``: what its own features say for itself, the line after it and the line before it."""
        w = self.weights / self.scale
        z = parts[:, 0] + (w[-1] - self.mean @ w)
        inside = np.ones(len(z), bool)
        inside[first[:-1]] = False
        z[1:] += parts[:-1, 1] * inside[1:]
        z[:-1] += parts[1:, 2] * inside[1:]
        z[first[:-1]] += w[-3]
        z[first[1:] - 1] += w[-2]
        return z

    def documents(self, good: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Score of every document: its lines' marginals weighted by length (a newline counts), on the scale of a probability."""
        weight = size + 1.0
        mean = np.add.reduceat(good * weight, first[:-1]) / np.add.reduceat(weight, first[:-1]) if len(first) > 1 else np.empty(0)
        if not self.fitted:
            return mean
        return 1 / (1 + np.exp(-(self.slope * mean + self.shift)))


def _train(features: np.ndarray, first: np.ndarray, labels: np.ndarray, model: Model) -> Model:
    """Gradient steps (Adam) on the mean log-likelihood of the line labels."""
    x = (features - model.mean) / model.scale
    pairs = np.ones(len(labels), bool)
    pairs[first[1:] - 1] = False
    at = np.flatnonzero(pairs)
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels[at], labels[at + 1]), 1)
    theta = np.concatenate([model.weights, model.trans.ravel()])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        z = x @ theta[:-4]
        trans = theta[-4:].reshape(2, 2)
        p, expected = marginals(np.stack([np.zeros_like(z), z], axis=1), trans, first)
        grad = np.concatenate([x.T @ (labels - p[:, 1]), (seen - expected).ravel()]) / len(labels) - PENALTY * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta = theta + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return replace(model, weights=theta[:-4], trans=theta[-4:].reshape(2, 2))


def fit_lines(own: np.ndarray, size: np.ndarray, first: np.ndarray, quality: np.ndarray) -> Model:
    """A model from lines (see :func:`line_features`) and the 0/1 quality of their documents.

    Without documents of both kinds all weights are zero: every score is 0.5.
    """
    features = with_neighbours(own, first) if len(own) else np.zeros((0, FEATURES), np.float32)
    blank = Model(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), np.zeros((2, 2)))
    if len(set(quality.tolist())) < 2:
        return blank
    scale = features.std(axis=0)
    model = replace(blank, mean=np.where(scale > 0, features.mean(axis=0), 0).astype(float), scale=np.where(scale > 0, scale, 1).astype(float))
    doc_of = np.repeat(np.arange(len(quality)), np.diff(first))
    labels = quality[doc_of].astype(np.int64)
    for _ in range(ROUNDS):
        model = _train(features, first, labels, model)
        good = model.lines(features, first)
        # in a bad document a line that looks good is good, but the line that looks worst stays bad
        worst = np.minimum.reduceat(good, first[:-1])[doc_of]
        labels = np.where((quality[doc_of] == 0) & ((good < 0.5) | (good <= worst)), 0, 1)
    model = replace(_train(features, first, labels, model), fitted=False)
    mean = model.documents(model.lines(features, first), size, first)
    slope, shift = _logistic(mean, quality)
    return replace(model, slope=slope, shift=shift, fitted=True)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a one-variable logistic regression by Newton steps."""
    a = np.stack([x, np.ones_like(x)], axis=1)
    theta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-a @ theta))
        hessian = (a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(2)
        theta = theta + np.linalg.solve(hessian, a.T @ (y - p) - 1e-2 * theta)
    return float(theta[0]), float(theta[1])


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """A model from about ``rows`` documents that ``labels`` (doc_id, quality) covers; null ids and labels are left out.

    The sample is drawn by hash of the doc_id from all labels, then limited
    to twice the number; of repeated ids the least label and text count, and
    texts over SAMPLE_BYTES are not learned from.  Only the sample's line
    features reach the driver.
    """
    labels = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).select("doc_id", F.col("quality").cast("int").alias("quality"))
    total = labels.count()
    buckets = 1 << 30
    share = min(1.0, rows / max(total, 1))
    sample = labels.filter(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(buckets)) < int(share * buckets)).groupBy("doc_id").agg(F.min("quality").alias("quality")).limit(2 * rows)
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    texts = texts.filter(F.octet_length("text") <= SAMPLE_BYTES).groupBy("doc_id").agg(F.min(F.struct("text", "quality")).alias("m")).select("m.text", "m.quality")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                own, size, first = line_features(part.column(0))
                cut = list(zip(first[:-1].tolist(), first[1:].tolist()))
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array([own[a:b].tobytes() for a, b in cut], pa.binary()),
                                                  pa.array([size[a:b].astype(np.int64).tobytes() for a, b in cut], pa.binary())], ["quality", "own", "size"])

    found = texts.mapInArrow(describe, "quality int, own binary, size binary").toArrow()
    own = [np.frombuffer(x.as_py(), np.float32).reshape(-1, OWN) for x in found["own"]]
    size = [np.frombuffer(x.as_py(), np.int64) for x in found["size"]]
    order = sorted(range(len(own)), key=lambda i: own[i].tobytes())  # the same model whatever the order of tasks
    own, size = [own[i] for i in order], [size[i] for i in order]
    quality = np.array([found["quality"][i].as_py() for i in order], np.int64)
    first = np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int64)
    return fit_lines(np.concatenate(own) if own else np.zeros((0, OWN), np.float32), np.concatenate(size) if size else np.zeros(0), first, quality)


def _parts(column: pa.Array) -> Iterator[pa.Array]:
    """The column in the order of its lines: whole, or row by row in parts of about PART bytes that end with a line."""
    data, offsets = text_bytes(column)
    if len(data) <= 2 * PART:
        yield column
        return
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        breaks = a + np.flatnonzero(data[a:b] == 10)
        ends = breaks[np.unique(np.searchsorted(breaks, np.arange(a + PART, b, PART)))[:-1]] if len(breaks) else breaks
        for x, y in zip([a, *(ends + 1).tolist()], [*ends.tolist(), b]):
            yield pa.array([data[x:y].tobytes()], pa.binary())


def scores(column: pa.Array, model: Model) -> np.ndarray:
    """Score of every text of a column, null and empty ones too.

    Long texts are described part by part; about 100 bytes a line are held.
    """
    data, offsets = text_bytes(column)
    breaks = np.concatenate([[0], np.cumsum(data == 10, dtype=np.int64)])
    first = np.concatenate([[0], np.cumsum(np.diff(breaks[offsets]) + 1)])
    del breaks
    n = int(first[-1])
    by_place = (model.weights / model.scale)[:3 * OWN].reshape(3, OWN).T
    parts, size, content, some = np.empty((n, 3)), np.empty(n, np.int64), np.empty(n, np.uint64), np.empty(n, bool)
    done = 0
    for texts in _parts(column):
        own, sizes, _, words, has = _describe(texts)
        at = slice(done, done + len(own))
        parts[at], size[at], content[at], some[at] = own @ by_place, sizes, words, has
        done = at.stop
    copies = _copies(content, np.repeat(np.arange(len(column), dtype=np.int32), np.diff(first)), some)
    del content, some
    for place in range(3):
        parts[:, place] += copies * by_place[COPIES, place]
    z = model.evidence(parts, first)
    del parts, copies
    return model.documents(model.good(z, first), size, first)


def score(docs: DataFrame, model: Model, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(<ident>, score) of every row, from the whole text; null and empty texts are one empty line; repeated rows give repeated rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[ident].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores(part.column(1), shared.value))], ["id", "score"])

    out = docs.select(F.col(ident).alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(apply, f"id {id_type}, score double")
    return out.withColumnRenamed("id", ident)


def keep_good(docs: DataFrame, model: Model, threshold: float, text: str = "text") -> DataFrame:
    """``docs`` without the rows that score below ``threshold``; columns unchanged, no shuffle.  Null and empty texts score as one empty line."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, batch.schema.names[at]):
                yield part.filter(pa.array(scores(part.column(at), shared.value) >= threshold))

    return docs.mapInArrow(apply, docs.schema)
