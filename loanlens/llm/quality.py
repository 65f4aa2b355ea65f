"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Every line is good or bad. A line's evidence is made of its own surface features and those of the
lines before and after it, each put into a few intervals; transitions tie neighbouring labels. The
field is fitted by gradient ascent on the log-likelihood of a bounded sample of labelled documents
(``sample`` documents of smallest hash, whose lines carry their document's label); the forward-
backward pass gives every line its marginal probability of being good, and the marginals, weighted
by line length, average to the document's score.

Inputs of a score are the text's characters only. Defined results: NULL and empty texts are one
empty line and get its score; labels that are NULL or whose document is missing are not used; a
document with several labels counts with its smallest; without any usable label the score is 0.5;
repeated rows are scored each; a kept column named like a result comes as ``doc_<name>``; texts of any
length are read whole; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as T
from .common import carried, ship
from .exchange import let_go

#: Documents the field is fitted on, at most.
SAMPLE = 4000
_EDGES = np.array([0.004, 0.02, 0.06, 0.12, 0.2, 0.35, 0.6])
_BINS = len(_EDGES) + 2
_FEATURES = 14
_WEIGHTS = 3 * _FEATURES * _BINS


def _byte_class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, np.int32)
    out[list(chars)] = 1
    return out


_LETTER = _byte_class(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(0xC0, 0x100)))
_CLASSES = [
    _byte_class(b"$%&*#@^~+=\\_"), _byte_class(b".,;:?'\"()-"), _byte_class(b"0123456789"),
    _byte_class(bytes(range(65, 91))), _byte_class(b"|"), _byte_class(b"!"), _byte_class(b"<>{}[]/"),
    _byte_class(bytes(range(0x80, 0xC0))), _LETTER]


def line_features(data: np.ndarray, offs: np.ndarray):
    """Feature intervals (lines x features), line weights and lines per document of a chunk."""
    n = len(data)
    docs = len(offs) - 1
    breaks = np.flatnonzero(data == 10)
    owner = np.searchsorted(offs, breaks, side="right") - 1
    per_doc = np.bincount(owner, minlength=docs) + 1
    starts = np.empty(len(breaks) + docs, np.int64)
    ends = np.empty_like(starts)
    first = np.cumsum(per_doc) - per_doc
    is_first = np.zeros(len(starts), bool)
    is_first[first] = True
    starts[is_first], starts[~is_first] = offs[:-1], breaks + 1
    is_last = np.zeros(len(starts), bool)
    is_last[first + per_doc - 1] = True
    ends[is_last], ends[~is_last] = offs[1:], breaks
    size = ends - starts
    ratio = np.maximum(size, 1)

    def count(table):
        total = np.zeros(n + 1, np.int32)
        np.cumsum(table[data], out=total[1:])
        return total[ends] - total[starts]

    counts = [count(c) for c in _CLASSES]
    ws, we, _ = T.words(data, offs)
    h = T.span_hash(T.prefix_hash(T.LOWER[data]), ws, we)
    lo, hi = np.searchsorted(ws, starts), np.searchsorted(ws, ends)
    words = hi - lo
    same = np.zeros(len(ws) + 1, np.int64)
    if len(ws) > 1:
        same[2:] = np.cumsum(h[1:] == h[:-1])
        same[1] = 0
    # repeats inside a line: word i equals word i - 1, both in the line
    repeats = np.where(words > 1, same[hi] - same[np.minimum(lo + 1, len(ws))], 0)
    line = T.span_hash(T.prefix_hash(data), starts, ends) if n else np.zeros(len(starts), np.uint64)
    again = np.zeros(len(starts), bool)
    again[1:] = (line[1:] == line[:-1]) & ~is_first[1:]
    letters = np.maximum(counts[8], 1)
    tail = np.zeros(len(starts), np.uint8)
    full = size > 0
    tail[full] = data[ends[full] - 1]
    continuous = [counts[0] / ratio, counts[1] / ratio, counts[2] / ratio, counts[3] / letters, counts[4] / ratio,
                  counts[5] / ratio, counts[6] / ratio, counts[7] / ratio, repeats / np.maximum(words, 1),
                  np.minimum(size / np.maximum(words, 1) / 30, 1), np.minimum(np.log1p(words) / 7, 1),
                  1 - counts[8] / ratio]
    out = np.zeros((len(starts), _FEATURES), np.int16)
    for j, c in enumerate(continuous):
        out[:, j] = np.searchsorted(_EDGES, c, side="right") + (c > 0)
    out[:, 12] = np.isin(tail, np.frombuffer(b".!?", np.uint8)) + 2 * again
    out[:, 13] = ~full
    return out, np.maximum(size, 1).astype(np.float64), per_doc


def _columns(features: np.ndarray, per_doc: np.ndarray) -> np.ndarray:
    """Weight indices of every line: its own intervals and those of both neighbours (-1: none)."""
    base = features.astype(np.int32) + np.arange(_FEATURES, dtype=np.int32) * _BINS
    step = _FEATURES * _BINS
    before, after = np.full_like(base, -1), np.full_like(base, -1)
    before[1:] = base[:-1] + step
    after[:-1] = base[1:] + 2 * step
    first = np.cumsum(per_doc) - per_doc
    before[first] = -1
    after[first + per_doc - 1] = -1
    return np.concatenate([base, before, after], axis=1)


def _marginals(emission: np.ndarray, per_doc: np.ndarray, trans: np.ndarray, start: np.ndarray, pairs: bool = False):
    """Forward-backward over all documents at once.

    ``emission``: log evidence for good over bad per line. Returns log P(good) marginals as
    probabilities and, with ``pairs``, expected transition and start counts.
    """
    order = np.argsort(-per_doc, kind="stable")
    length = per_doc[order]
    first = (np.cumsum(per_doc) - per_doc)[order]
    steps = int(length[0]) if len(length) else 0
    alive = [int(np.searchsorted(-length, -t, side="left")) for t in range(steps)]  # documents longer than t
    e = np.zeros((len(emission), 2))
    e[:, 1] = emission
    fwd, bwd = np.empty_like(e), np.zeros_like(e)
    prev = None
    for t in range(steps):
        at = first[:alive[t]] + t
        a = start[None, :] if t == 0 else np.logaddexp(prev[:alive[t], :1] + trans[0], prev[:alive[t], 1:] + trans[1])
        a = a + e[at]
        a = a - a.max(1, keepdims=True)
        fwd[at] = a
        prev = a
    for t in range(steps - 2, -1, -1):
        k = alive[t + 1]
        at = first[:k] + t
        nxt = bwd[at + 1] + e[at + 1]
        b = np.stack([np.logaddexp(trans[0, 0] + nxt[:, 0], trans[0, 1] + nxt[:, 1]),
                      np.logaddexp(trans[1, 0] + nxt[:, 0], trans[1, 1] + nxt[:, 1])], 1)
        bwd[at] = b - b.max(1, keepdims=True)
    both = fwd + bwd
    good = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500)))
    if not pairs:
        return good
    inner = np.ones(len(e), bool)
    inner[np.cumsum(per_doc) - 1] = False
    at = np.flatnonzero(inner)
    joint = fwd[at][:, :, None] + trans[None] + (e[at + 1] + bwd[at + 1])[:, None, :]
    joint = np.exp(joint - joint.max((1, 2), keepdims=True))
    joint /= joint.sum((1, 2), keepdims=True)
    g = good[first].sum()
    return good, joint.sum(0), np.array([len(first) - g, g])


def _emission(columns: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.append(w, 0.0)[columns].sum(1)


def fit(features: list[np.ndarray], labels: list[int], rounds: int = 150) -> np.ndarray:
    """Weights, transitions and start scores of the field, by Adam on the penalised log-likelihood."""
    per_doc = np.array([len(f) for f in features])
    columns = _columns(np.concatenate(features), per_doc)
    y = np.repeat(np.array(labels, np.float64), per_doc)
    # a document counts once, however many lines it has
    weight = np.repeat(1 / per_doc, per_doc)
    theta = np.zeros(_WEIGHTS + 6)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    last = np.zeros(len(y), bool)
    last[np.cumsum(per_doc) - 1] = True
    inner = np.flatnonzero(~last)
    seen_pairs = np.zeros((2, 2))
    np.add.at(seen_pairs, (y[inner].astype(int), y[inner + 1].astype(int)), 1)
    lab = np.array(labels)
    seen_start = np.array([(lab == 0).sum(), (lab == 1).sum()], np.float64)
    flat = np.where(columns < 0, _WEIGHTS, columns).ravel()
    for r in range(1, rounds + 1):
        trans, start = theta[_WEIGHTS:_WEIGHTS + 4].reshape(2, 2), theta[_WEIGHTS + 4:]
        good, pairs, begin = _marginals(_emission(columns, theta[:_WEIGHTS]), per_doc, trans, start, True)
        push = np.repeat(((y - good) * weight)[:, None], columns.shape[1], 1).ravel()
        grad = np.concatenate([np.bincount(flat, weights=push, minlength=_WEIGHTS + 1)[:_WEIGHTS],
                               (seen_pairs - pairs).ravel() / max(per_doc.mean(), 1), seen_start - begin])
        grad = grad / len(labels) - 1e-4 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        theta = theta + 0.08 * (m / (1 - 0.9 ** r)) / (np.sqrt(v / (1 - 0.99 ** r)) + 1e-8)
    return theta


def document_scores(data: np.ndarray, offs: np.ndarray, theta: np.ndarray):
    """Length-weighted mean marginal of a chunk's documents, and every line's marginal."""
    features, size, per_doc = line_features(data, offs)
    good = _marginals(_emission(_columns(features, per_doc), theta[:_WEIGHTS]), per_doc,
                      theta[_WEIGHTS:_WEIGHTS + 4].reshape(2, 2), theta[_WEIGHTS + 4:])
    first = np.cumsum(per_doc) - per_doc
    return np.add.reduceat(good * size, first) / np.add.reduceat(size, first), good, per_doc


def held_out(c, mod: int = 5):
    return F.coalesce(F.crc32(F.encode(c.cast("string"), "UTF-8")) % mod == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, mod: int = 5) -> np.ndarray | None:
    """Fit the field on at most ``sample`` labelled documents outside the held-out fold.

    Features are made where the documents are; the fit runs in one task on the bounded sample.
    """
    ship(docs.sparkSession)
    chosen = (labels.where("quality is not null and doc_id is not null").groupBy("doc_id")
              .agg(F.min("quality").alias("quality")).where(~held_out(F.col("doc_id"), mod))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        "quality", "text", F.xxhash64("doc_id").alias("h"))

    def make(batches):
        for batch in batches:
            at = 0
            for _, data, offs in T.chunks(batch.column(1)):
                f, _, per = line_features(data, offs)
                cut = np.cumsum(per)
                part = [x.tobytes() for x in np.split(f, cut[:-1])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(2).slice(at, len(per)), batch.column(0).slice(at, len(per)).cast(pa.int32()),
                     pa.array(part, pa.binary())], names=["h", "quality", "f"])
                at += len(per)

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("h", "ascending"), ("quality", "ascending")]).slice(0, sample)
        theta = fit([np.frombuffer(f, np.int16).reshape(-1, _FEATURES) for f in t["f"].to_pylist()],
                    t["quality"].to_pylist())
        return pa.table({"theta": pa.array([theta.tobytes()], pa.binary())})

    made = rows.mapInArrow(make, "h long, quality int, f binary")
    got = made.withColumn("one", F.lit(1)).groupBy("one").applyInArrow(run, "theta binary").collect()
    return np.frombuffer(got[0]["theta"]) if got else None


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = SAMPLE,
             keep: list[str] | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per document, with the columns ``keep`` of the documents."""
    theta = train(docs, labels, sample)
    kept = [c for c in (keep or []) if c != "doc_id"]
    own = [f"_k{i}" for i in range(len(kept))]

    def run(batches):
        for batch in batches:
            at = 0
            for _, data, offs in T.chunks(batch.column("_text")):
                n = len(offs) - 1
                score = np.full(n, 0.5) if theta is None else document_scores(data, offs, theta)[0]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(at, n) for c in ("doc_id", *own)), pa.array(score)],
                    names=["doc_id", *own, "_score"])
                at += n
            let_go()

    types = dict(docs.dtypes)
    schema = ", ".join([f"doc_id {types['doc_id']}", *(f"{o} {types[c]}" for o, c in zip(own, kept, strict=True)),
                        "_score double"])
    rows = docs.select("doc_id", *(F.col(c).alias(o) for o, c in zip(own, kept, strict=True)),
                       F.col("text").alias("_text")).mapInArrow(run, schema)
    names = carried(kept, ["doc_id", "held_out", "score", "predicted"])
    return rows.select("doc_id", *(F.col(o).alias(c) for o, c in zip(own, names, strict=True)),
                       held_out(F.col("doc_id")).alias("held_out"), F.col("_score").alias("score"),
                       (F.col("_score") >= threshold).cast("int").alias("predicted"))
