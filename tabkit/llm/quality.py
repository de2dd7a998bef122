"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.llm.batches import stage_batched
from tabkit.llm.words import SPACES, mix, pieces, split_words

UPPER, DIGIT, SYMBOL, PUNCT, HIGH, ALPHA = (np.zeros(256, dtype=bool) for _ in range(6))
UPPER[0x41:0x5B] = True
DIGIT[0x30:0x3A] = True
ALPHA[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
HIGH[0x80:] = True
SYMBOL[[ord(c) for c in "!#$%&*|~^<>{}[]=+\\/@_"]] = True
PUNCT[[ord(c) for c in ".,;:?'\"()-"]] = True

CUTS = (0.02, 0.1, 0.25, 0.5, 0.75)
LABELLED_DOCS, LINES_OF_ONE, RUN_LINES = 3000, 400, 20


@dataclass
class Lines:
    row0: int
    first: np.ndarray  # rows + 1 line offsets
    length: np.ndarray  # bytes of each line
    x: np.ndarray  # lines x features


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


def line_features(row0: int, data: np.ndarray, at: np.ndarray) -> Lines:
    """Lines of a piece of whole rows and their features, those of the neighbouring lines included.

    A text without a line break is one line; an empty text is one empty line.
    """
    rows = len(at) - 1
    breaks = np.flatnonzero(data == 0x0A)
    per_row = np.searchsorted(breaks, at)
    n = np.diff(per_row) + 1
    first = np.concatenate([[0], np.cumsum(n)])
    start, end = np.empty(first[-1], dtype=np.int64), np.empty(first[-1], dtype=np.int64)
    is_first = np.zeros(first[-1], dtype=bool)
    is_first[first[:-1]] = True
    start[is_first], start[~is_first] = at[:-1], breaks + 1
    is_last = np.zeros(first[-1], dtype=bool)
    is_last[first[1:] - 1] = True
    end[is_last], end[~is_last] = at[1:], breaks
    size = end - start

    def total(flag: np.ndarray) -> np.ndarray:
        c = np.concatenate([[0], np.cumsum(flag, dtype=np.int64)])
        return c[end] - c[start]

    up, digit, symbol, punct, high, alpha = (total(t[data]) for t in (UPPER, DIGIT, SYMBOL, PUNCT, HIGH, ALPHA))
    w = split_words(data, at, SPACES)
    line = np.searchsorted(start, w.starts, side="right") - 1
    lines = len(start)
    words = np.bincount(line, minlength=lines)
    h = w.hashes()
    last = data[w.ends - 1] if len(h) else np.zeros(0, dtype=np.uint8)
    by_line = lambda flag: np.bincount(line[flag], minlength=lines)
    same = np.zeros(len(h), dtype=bool)
    same[1:] = (h[1:] == h[:-1]) & (line[1:] == line[:-1])
    order = np.lexsort((h, line))
    hs, ls = h[order], line[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (hs[1:] != hs[:-1]) | (ls[1:] != ls[:-1])
    distinct = np.bincount(ls[new], minlength=lines)
    # a line that stands elsewhere in the same text: equal sums of word hashes
    with np.errstate(over="ignore"):
        c = np.concatenate([[np.uint64(0)], np.cumsum(h, dtype=np.uint64)])
    a = np.searchsorted(w.starts, start)
    b = np.searchsorted(w.starts, end)
    mark = c[b] - c[a]
    row = np.repeat(np.arange(rows), n)
    order = np.lexsort((mark, row))
    tie = (mark[order][1:] == mark[order][:-1]) & (row[order][1:] == row[order][:-1]) & (words[order][1:] > 0)
    twice = np.zeros(lines, dtype=bool)
    twice[order[1:][tie]] = True
    twice[order[:-1][tie]] = True
    ratios = np.stack(
        [
            _ratio(up, alpha), _ratio(digit, size), _ratio(symbol, size), _ratio(punct, size), _ratio(high, size), by_line(SYMBOL[last]) / np.maximum(words, 1),
            by_line(PUNCT[last]) / np.maximum(words, 1), 1 - distinct / np.maximum(words, 1), by_line(same) / np.maximum(words, 1), by_line(w.ends - w.starts == 1) / np.maximum(words, 1), twice.astype(float),
        ],
        axis=1,
    )
    long = np.stack([np.log1p(size) / 8, np.log1p(words) / 6, np.minimum(_ratio(size, words), 30) / 10, words == 0, is_first, is_last], axis=1)
    steps = (ratios[:, :, None] > np.array(CUTS)).reshape(lines, -1)
    own = np.concatenate([ratios, steps], axis=1)
    pad = np.zeros((1, ratios.shape[1]))
    before = np.where(is_first[:, None], 0, np.concatenate([pad, ratios[:-1]]))
    after = np.where(is_last[:, None], 0, np.concatenate([ratios[1:], pad]))
    return Lines(row0, first, size, np.concatenate([np.ones((lines, 1)), long, own, before, after], axis=1).astype(np.float32))


def _grid(first: np.ndarray, values: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """values of the given documents as a time x document grid, with its mask."""
    n = np.diff(first)[docs]
    t = np.arange(n.max(initial=0))[:, None]
    mask = t < n[None, :]
    at = np.where(mask, first[:-1][docs][None, :] + t, 0)
    return np.where(mask, values[at], 0.0), mask


def _chain(e: np.ndarray, mask: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward of two-label chains: P(good) per line, expected transitions summed, log partition per document.

    Only log odds are carried: label 0 scores 0, label 1 scores e. Documents are
    the columns of the grid; padding steps change nothing.
    """
    steps, docs = e.shape
    alpha = np.zeros((steps, 2, docs))
    alpha[0, 1] = e[0]
    for t in range(1, steps):
        prev = alpha[t - 1]
        m = mask[t]
        a0 = np.logaddexp(prev[0] + trans[0, 0], prev[1] + trans[1, 0])
        a1 = np.logaddexp(prev[0] + trans[0, 1], prev[1] + trans[1, 1]) + e[t]
        alpha[t, 0], alpha[t, 1] = np.where(m, a0, prev[0]), np.where(m, a1, prev[1])
    z = np.logaddexp(alpha[-1, 0], alpha[-1, 1])
    beta = np.zeros((2, docs))
    good = np.zeros((steps, docs))
    pairs = np.zeros((2, 2))
    for t in range(steps - 1, -1, -1):
        good[t] = np.exp(np.minimum(0, alpha[t, 1] + beta[1] - z))
        if t:
            m, prev = mask[t], alpha[t - 1]
            right = [beta[0], beta[1] + e[t]]
            for i in (0, 1):
                for j in (0, 1):
                    pairs[i, j] += np.exp(np.minimum(0, prev[i] + trans[i, j] + right[j] - z))[m].sum()
            b = [np.logaddexp(right[0] + trans[i, 0], right[1] + trans[i, 1]) for i in (0, 1)]
            beta = np.where(m, np.stack(b), beta)
    return good, pairs, z


def _batches(first: np.ndarray, size: int = 256) -> list[np.ndarray]:
    """Documents of similar line counts together, about size of them or fewer for long ones."""
    n = np.diff(first)
    order = np.argsort(n, kind="stable")
    out, at = [], 0
    while at < len(order):
        end = min(len(order), at + size)
        while end - at > 1 and (end - at) * n[order[end - 1]] > 400_000:
            end = at + (end - at) // 2
        out.append(order[at:end])
        at = end
    return out


@dataclass
class Model:
    weights: np.ndarray
    trans: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def line_marginals(self, first: np.ndarray, x: np.ndarray) -> np.ndarray:
        e = x @ self.weights
        good = np.zeros(len(e))
        for docs in _batches(first):
            grid, mask = _grid(first, e, docs)
            p, _, _ = _chain(grid, mask, self.trans)
            at = first[:-1][docs][None, :] + np.arange(len(mask))[:, None]
            good[at[mask]] = p[mask]
        return good

    def document(self, first: np.ndarray, length: np.ndarray, good: np.ndarray) -> np.ndarray:
        """Length-weighted mean of the line marginals; an empty line weighs one byte."""
        weight = length + 1.0
        return np.add.reduceat(weight * good, first[:-1]) / np.add.reduceat(weight, first[:-1])

    def score(self, lines: Lines) -> tuple[np.ndarray, np.ndarray]:
        """(score per document, P(good) per line)."""
        good = self.line_marginals(lines.first, lines.x)
        mean = np.clip(self.document(lines.first, lines.length, good), 1e-6, 1 - 1e-6)
        return 1 / (1 + np.exp(-(self.slope * np.log(mean / (1 - mean)) + self.offset))), good


def fit(first: np.ndarray, length: np.ndarray, x: np.ndarray, label: np.ndarray, rounds: int = 150, penalty: float = 0.5) -> Model:
    """Maximum likelihood with an L2 penalty by Adam steps; every line of a document carries the document's label.

    A logistic curve over the documents' length-weighted means (slope and
    offset by Newton's method) then turns the mean into a probability.
    """
    y = np.repeat(label.astype(float), np.diff(first))
    groups = [(docs, *_grid(first, np.arange(len(y)), docs)) for docs in _batches(first)]
    w, trans = np.zeros(x.shape[1]), np.zeros((2, 2))
    same = np.diff(first) - 1
    seen = np.diag([float(same[label == 0].sum()), float(same[label == 1].sum())])
    p = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(p), np.zeros_like(p)
    per = 1.0 / max(1, len(label))
    for step in range(1, rounds + 1):
        w, trans = p[:-4], p[-4:].reshape(2, 2)
        e = x @ w
        good, pairs = np.zeros(len(y)), np.zeros((2, 2))
        for _, at, mask in groups:
            at = at.astype(int)
            g, q, _ = _chain(np.where(mask, e[at], 0.0), mask, trans)
            good[at[mask]] = g[mask]
            pairs += q
        grad = np.concatenate([x.T @ (y - good), (seen - pairs).ravel()]) * per - penalty * per * p
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        p = p + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    model = Model(p[:-4].copy(), p[-4:].reshape(2, 2).copy())
    mean = np.clip(model.document(first, length, model.line_marginals(first, x)), 1e-6, 1 - 1e-6)
    s = np.log(mean / (1 - mean))
    a, b = 1.0, 0.0
    for _ in range(25):
        q = 1 / (1 + np.exp(-(a * s + b)))
        r = q * (1 - q) + 1e-9
        g = np.array([((label - q) * s).sum() - 0.1 * (a - 1), (label - q).sum() - 0.1 * b])
        hess = np.array([[(r * s * s).sum() + 0.1, (r * s).sum()], [(r * s).sum(), r.sum() + 0.1]])
        move = np.linalg.solve(hess, g)
        a, b = a + np.clip(move[0], -0.5, 0.5), b + np.clip(move[1], -1, 1)
    model.slope, model.offset = max(a, 0.05), b
    return model


def held_out(id_column: str = "doc_id") -> Column:
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0


def sampled_lines(n: int, most: int) -> np.ndarray:
    """All of n lines, or about ``most`` of them: runs of RUN_LINES neighbours in hash order from the whole text."""
    if n <= most:
        return np.arange(n)
    runs = mix(np.arange(-(-n // RUN_LINES), dtype=np.uint64)).argsort()[: max(1, most // RUN_LINES)]
    own = (np.sort(runs)[:, None] * RUN_LINES + np.arange(RUN_LINES)).ravel()
    return own[own < n]


def train(docs: DataFrame, labels: DataFrame, max_docs: int = LABELLED_DOCS, max_lines: int = LINES_OF_ONE) -> Model | None:
    """Fit on a bounded, repeatable sample of labelled rows outside the held-out fifth; None without any.

    The sample is the first max_docs labelled ids in hash order; of a document
    of more than max_lines lines the fit uses about so many, in short runs from
    the whole text (scores use them all).
    """
    rows = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", F.col("quality").cast("int").alias("quality"))
    ids = rows.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)

    def features(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            ids, length, x = [], [], []
            for row0, data, at in pieces(batch.column(1)):
                got = line_features(row0, data, at)
                for i in range(len(got.first) - 1):
                    own = got.first[i] + sampled_lines(got.first[i + 1] - got.first[i], max_lines)
                    length.append(got.length[own].tobytes())
                    x.append(got.x[own].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(length, type=pa.binary()), pa.array(x, type=pa.binary())], ["doc_id", "quality", "length", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    # max_docs rows bound the broadcast
    text = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(ids), "doc_id")
    got = stage_batched(text.select("doc_id", "text", "quality").mapInArrow(features, f"doc_id {kind}, quality int, length binary, x binary"))
    found = got.orderBy(F.xxhash64("doc_id"), "doc_id", "length").limit(2 * max_docs).collect()
    if not found:
        return None
    length = [np.frombuffer(r["length"], dtype=np.int64) for r in found]
    first = np.concatenate([[0], np.cumsum([len(a) for a in length])])
    x = np.frombuffer(b"".join(r["x"] for r in found), dtype=np.float32).reshape(first[-1], -1).astype(float)
    return fit(first, np.concatenate(length), x, np.array([r["quality"] for r in found]))


def quality_scores(docs: DataFrame, labels: DataFrame, least: float = 0.3, id_column: str = "doc_id", model: Model | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted, n_lines, bad_lines of every whole text.

    A linear-chain conditional random field labels each line good or bad from
    its own and its neighbours' features; its forward-backward marginals,
    weighted by line length and passed through a fitted logistic curve, are the
    document's score. Only the text enters a score. predicted is 1 from a score
    of ``least`` on. bad_lines counts lines whose P(good) is under one half.

    Null and empty text are one empty line and get a score like any other.
    Without labelled rows every score is 0.5. A null id is not held out. Every
    row gives one row.
    """
    model = model or train(docs, labels)
    kind = docs.schema[id_column].dataType.simpleString()

    def scores(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for row0, data, at in pieces(batch.column(1)):
                got = line_features(row0, data, at)
                rows = len(got.first) - 1
                score, bad = np.full(rows, 0.5), np.zeros(rows, dtype=np.int64)
                if model is not None:
                    score, good = model.score(got)
                    bad = np.add.reduceat((good < 0.5).astype(np.int64), got.first[:-1])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row0, rows), batch.column(2).slice(row0, rows), pa.array(score), pa.array(np.diff(got.first).astype(np.int64)), pa.array(bad)], [id_column, "held_out", "score", "n_lines", "bad_lines"])

    rows = docs.select(id_column, F.col("text").cast("string").alias("text"), F.coalesce(held_out(id_column), F.lit(False)).alias("held_out"))
    out = stage_batched(rows.mapInArrow(scores, f"{id_column} {kind}, held_out boolean, score double, n_lines long, bad_lines long"))
    return out.select(id_column, "held_out", "score", (F.col("score") >= least).cast("int").alias("predicted"), "n_lines", "bad_lines")


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.3, model: Model | None = None) -> DataFrame:
    """The rows of docs, all columns, whose text scores at least ``least``; one pass, nothing is shuffled."""
    model = model or train(docs, labels)
    if model is None:
        return docs
    at = docs.columns.index("text")

    def keep(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for row0, data, ends in pieces(batch.column(at)):
                score, _ = model.score(line_features(row0, data, ends))
                yield batch.slice(row0, len(score)).filter(pa.array(score >= least))

    return stage_batched(docs.mapInArrow(keep, docs.schema))
