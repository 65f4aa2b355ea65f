"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, what is no letter becomes one blank, and n-grams of one to ``ORDER`` characters
are hashed into ``BUCKETS`` features. A feature's value is its share of the text's n-grams of that order times its
inverse document frequency, counted over all training documents. Weights are learned by
follow-the-regularised-leader (FTRL-proximal) with elastic-net penalties on a bounded sample, at most
``sample`` documents, dealt evenly over the languages; the first penalty leaves most weights at
zero, so only the others travel to the tasks. A fifth of the sample is held back to fit the temperature
that calibrates the probabilities.

Inputs of a prediction are the text's characters only. Defined results: ``lang_pred`` is ``und`` with
score 0 for texts that are NULL or hold no letter, and for all texts if there is nothing to learn
from; equal probabilities go to the smaller language name; a NULL doc_id is hashed as the empty text (not held out);
documents without text or with a NULL lang are not learned from; repeated rows count as often as they occur;
very long texts are read whole, in pieces; an empty table gives no rows; other columns are not read,
so their names cannot clash.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, ship, small

ORDER, BUCKETS = 3, 1 << 18
#: Documents the model is fitted and calibrated on, at most.
SAMPLE = 4000
UNKNOWN = "und"
#: FTRL: step size, its smoothing, both penalties, passes over the sample.
ALPHA, BETA, L1, L2, PASSES = 0.5, 1.0, 0.02, 0.001, 6
#: Characters read at once.
PIECE = 1 << 20
_U = np.uint64
_MULTIPLY = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)
_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def ngrams(text: str) -> list[np.ndarray] | None:
    """Buckets of the text's n-grams, an array for each order; None without any letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letter_table()[codes]
    if not letter.any():
        return None
    keep = letter.copy()
    keep[1:] |= letter[:-1]                   # one blank after each run of letters
    codes = np.where(letter, codes, 32)[keep].astype(np.uint64)
    if codes[0] != 32:
        codes = np.concatenate([np.array([32], np.uint64), codes])
    out = []
    h = np.zeros(len(codes), np.uint64)
    for k in range(min(ORDER, len(codes))):
        h = (h[:len(codes) - k] + codes[k:] + _U(1)) * _MULTIPLY[0]
        mixed = (h ^ (h >> _U(29))) * _MULTIPLY[1]
        out.append((mixed >> _U(32)).astype(np.int64) & (BUCKETS - 1))
    return out


def features(text: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Distinct buckets of a text and their shares."""
    grams = ngrams(text)
    if grams is None:
        return None
    at = np.concatenate(grams)
    share = np.concatenate([np.full(len(g), 1 / len(g)) for g in grams])
    idx, where = np.unique(at, return_inverse=True)
    return idx, np.bincount(where, weights=share)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def _shrunk(z: np.ndarray, n: np.ndarray, l1: float = L1, l2: float = L2) -> np.ndarray:
    """Weights of the leader: zero within the first penalty."""
    return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + l2))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Weights (buckets x classes) and intercepts by FTRL-proximal with elastic net."""
    z, n = np.zeros((BUCKETS, classes)), np.zeros((BUCKETS, classes))
    bz, bn = np.zeros(classes), np.zeros(classes)
    rng = np.random.default_rng(seed)
    for _ in range(PASSES):
        for i in rng.permutation(len(rows)):
            idx, x = rows[i]
            w, b = _shrunk(z[idx], n[idx]), _shrunk(bz, bn, 0.0, 0.0)
            wrong = softmax(x @ w + b)
            wrong[y[i]] -= 1
            g = x[:, None] * wrong
            step = (np.sqrt(n[idx] + g * g) - np.sqrt(n[idx])) / ALPHA
            z[idx] += g - step * w
            n[idx] += g * g
            bz += wrong - (np.sqrt(bn + wrong * wrong) - np.sqrt(bn)) / ALPHA * b
            bn += wrong * wrong
    return _shrunk(z, n), _shrunk(bz, bn, 0.0, 0.0)


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """Divisor of the logits of least negative log-likelihood, by golden sections of its logarithm."""
    if not len(y):
        return 1.0
    y = np.asarray(y)

    def loss(t: float) -> float:
        z = logits / np.exp(t)
        z = z - z.max(1, keepdims=True)
        return float((np.log(np.exp(z).sum(1)) - z[np.arange(len(y)), y]).mean())
    a, b, ratio = -3.0, 3.0, (np.sqrt(5) - 1) / 2
    for _ in range(50):
        c, d = b - ratio * (b - a), a + ratio * (b - a)
        a, b = (a, d) if loss(c) <= loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


@dataclass
class Model:
    """Nonzero weights only: row ``place[bucket]`` of ``weights`` (row 0 is zero), times the idf."""
    langs: list[str]
    place: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    heat: float

    def logits(self, text: str) -> np.ndarray | None:
        grams = ngrams(text)
        if grams is None:
            return None
        out = self.bias.copy()
        for g in grams:
            for s in range(0, len(g), PIECE):
                out += self.weights[self.place[g[s:s + PIECE]]].sum(0) / len(g)
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        z = None if text is None else self.logits(text)
        if z is None:
            return UNKNOWN, 0.0
        p = softmax(z / self.heat)
        best = int(np.argmax(p))
        return self.langs[best], float(p[best])


def _held(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def document_frequency(known: DataFrame) -> tuple[int, np.ndarray]:
    """Training documents with a letter, and how many of them hold each bucket."""
    def run(batches):
        for batch in batches:
            count, n, slot = np.zeros(BUCKETS, np.int64), 0, np.empty(BUCKETS, np.int64)
            for text in batch.column(0):
                grams = ngrams(text.as_py())
                if grams is not None:
                    n += 1
                    at = np.concatenate(grams)
                    turn = np.arange(len(at))
                    slot[at] = turn            # the last of equal buckets stays
                    count[at[slot[at] == turn]] += 1
            at = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(count[at], n))],
                                             names=["bucket", "n"])
    got = known.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out, total = np.zeros(BUCKETS, np.int64), 0   # at most a row per bucket reaches the driver
    bucket, n = np.asarray(got["bucket"]), np.asarray(got["n"])
    if len(bucket):
        total = int(n[bucket == -1].sum())
        out[bucket[bucket >= 0]] = n[bucket >= 0]
    return total, out


def train(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """The model learned from the documents that are not held out; None if there are none."""
    ship(docs.sparkSession)
    known = docs.select(F.col("doc_id"), F.col("text"), F.col("lang")).where(
        "text is not null and lang is not null").where(~_held(F.col("doc_id")))
    total, holds = document_frequency(known)
    if not total:
        return None
    idf = (np.log((1 + total) / (1 + holds)) + 1)
    key = F.xxhash64("doc_id", "text")
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    # of each language, about twice the sample by hash is ranked, however many documents it has
    rows_of = small(known.groupBy("lang").agg(F.count("*").alias("rows")))
    share = F.pmod(F.xxhash64("text", "doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    some = known.join(rows_of, "lang").where(share * F.col("rows") < 2 * sample)
    # every language takes its turn, so the sample is bounded whatever their number and shares
    chosen = (some.select("doc_id", "lang", key.alias("h")).withColumn("turn", F.row_number().over(order))
              .where(F.col("turn") <= sample).orderBy("turn", "h", "lang").limit(sample).select(F.col("h").alias("wanted")))
    wanted = cut_lineage(chosen.distinct())  # at most ``sample`` rows
    rows = known.withColumn("h", key).join(F.broadcast(wanted), F.col("h") == F.col("wanted"), "left_semi").select(
        "h", "lang", "text").dropDuplicates()

    def make(batches):
        for batch in batches:
            hs, langs, idxs, shares = [], [], [], []
            for h, lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                got = features(text)
                if got is not None:
                    hs.append(h)
                    langs.append(lang)
                    idxs.append(got[0].astype(np.int32).tobytes())
                    shares.append(got[1].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(hs, pa.int64()), pa.array(langs, pa.string()),
                                              pa.array(idxs, pa.binary()), pa.array(shares, pa.binary())],
                                             names=["h", "lang", "idx", "share"])

    def learn(t: pa.Table) -> pa.Table:
        found = sorted(zip(*(t[c].to_pylist() for c in ("h", "lang", "idx", "share")), strict=True))[:sample]
        langs = sorted({r[1] for r in found})
        data, y, back = [], [], []
        for h, lang, idx, share in found:
            at = np.frombuffer(idx, np.int32).astype(np.int64)
            data.append((at, np.frombuffer(share) * idf[at]))
            y.append(langs.index(lang))
            back.append(h % 5 == 0)
        y, back = np.array(y), np.array(back)
        fitted = [r for r, b in zip(data, back, strict=True) if not b] or data
        w, bias = fit(fitted, y[~back] if not back.all() else y, len(langs))
        held = np.array([r[1] @ w[r[0]] + bias for r, b in zip(data, back, strict=True) if b])
        heat = temperature(held, y[back])
        some = np.flatnonzero(np.abs(w).sum(1) > 0)
        place = np.zeros(BUCKETS, np.int32)
        place[some] = np.arange(1, len(some) + 1)
        weights = np.concatenate([np.zeros((1, len(langs))), w[some] * idf[some, None]])
        return pa.table({"model": pa.array([pickle.dumps((langs, place, weights, bias, heat))], pa.binary())})

    got = rows.mapInArrow(make, "h long, lang string, idx binary, share binary").withColumn("one", F.lit(1)).groupBy(
        "one").applyInArrow(learn, "model binary").collect()
    return Model(*pickle.loads(got[0]["model"])) if got else None


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` per document."""
    model = train(docs, sample)

    def run(batches):
        for batch in batches:
            found = [(UNKNOWN, 0.0) if model is None else model.predict(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([p for p, _ in found], pa.string()),
                 pa.array([s for _, s in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    rows = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, lang_pred string, score double")
    return rows.select("doc_id", _held(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
