"""Language-model scoring by prediction by partial matching (PPM).

The model is a byte-context trie of order four, trained on the training documents: counts of every
byte after every context of up to four bytes. A byte that is new in a context escapes to the next
shorter one; escapes are estimated by method D (half the distinct bytes seen against all bytes seen),
and symbols of longer contexts are excluded from the shorter ones. Every text ends with a symbol of its own,
the byte 255, which UTF-8 never holds; it is learned after its contexts like any other. The score of a text
is the sum of the base-10 logarithms of the probabilities of its bytes and its end (bytes before a text's
start count as zero bytes), so the probabilities of all texts sum to one at most.

The trie is never gathered anywhere: its five-byte strings are partitioned by the last two bytes of
their context, so that a node, its shorter contexts and its children meet in one group of at most
2**24 strings, however large the corpus; only counts of byte pairs (65,536 at most) are collected.
A plain unigram word model with add-one smoothing is scored beside it (``base_score``). Word and
trie facts reach the documents by the ask-and-answer exchange of ``exchange.py``.

Defined results: NULL and empty texts have one token, the end, and its probability at a start; NULL doc_ids
are training rows; repeated rows are learned as often as they occur; with no training document at all every
byte and end has probability 1/256; an empty table gives no rows; very long texts are chunks of their own;
other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange as X
from . import textkit as T
from .common import cut_lineage

_U = np.uint64
#: Longest context in bytes.
ORDER = 4
#: The byte that ends every text.
END = 0xFF
_END = _U(0xE7D1A2C3B4958677)
_DENSE = 12_000_000


def held_out(chunk: X.Chunk, mod: int, rest: int) -> np.ndarray:
    return np.array([not m and zlib.crc32(str(i).encode()) % mod == rest
                     for i, m in zip(chunk.ids.tolist(), chunk.missing.tolist(), strict=True)], bool)


def _pieces(chunk: X.Chunk):
    texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(chunk.ids),
                                             [None, pa.py_buffer(chunk.offs), pa.py_buffer(chunk.data)])
    return T.chunks(texts)


def _tokens(chunk: X.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the chunk and the words per document."""
    got = [T.word_hashes(d, o) for _, d, o in _pieces(chunk)]
    return (np.concatenate([*(h for h, _ in got), np.zeros(0, np.uint64)]),
            np.concatenate([*(n for _, n in got), np.zeros(0, np.int64)]))


def _ended(chunk: X.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts, each with its end, and where the texts begin."""
    size = np.diff(chunk.offs)
    data = np.full(len(chunk.data) + len(size), END, np.uint8)
    data[np.arange(len(chunk.data)) + np.repeat(np.arange(len(size)), size)] = chunk.data
    return data, chunk.offs + np.arange(len(size) + 1)


def _strings(chunk: X.Chunk, order: int = ORDER) -> np.ndarray:
    """String of ``order + 1`` bytes ending at every byte and end (big-endian; zero bytes before a text's start)."""
    data, offs = _ended(chunk)
    code = data.astype(np.uint64)
    n = len(code)
    at = np.arange(n) - np.repeat(offs[:-1], np.diff(offs))
    for k in range(1, order + 1):
        shifted = np.zeros(n, np.uint64)
        shifted[k:] = data[:n - k]
        shifted[at < k] = 0
        code |= shifted << _U(8 * k)
    return code


def _of_training(chunk: X.Chunk, out: np.ndarray) -> np.ndarray:
    return np.repeat(~out, np.diff(chunk.offs) + 1)


def _word_parts(words: np.ndarray, parts: int):
    """Distinct sorted word hashes; each hash range is a slice."""
    return np.searchsorted((words >> _U(48)) * _U(parts) >> _U(16), np.arange(parts + 1).astype(np.uint64))


def _string_parts(codes: np.ndarray, parts: int):
    """Order of distinct strings by the group of their last two context bytes, and where each group begins."""
    group = (T.mix64(codes >> _U(8) & _U(0xFFFF)) % _U(parts)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    return order, np.searchsorted(group[order], np.arange(parts + 1))


def _distinct(values: np.ndarray, chosen: np.ndarray):
    """Distinct values and how often each is among the chosen ones."""
    u = np.unique(values)
    v, c = np.unique(values[chosen], return_counts=True)
    n = np.zeros(len(u), np.uint32)
    n[np.searchsorted(u, v)] = c
    return u, n


def _ask(parts: int, mod: int, rest: int):
    def fn(chunk):
        out = held_out(chunk, mod, rest)
        words, per = _tokens(chunk)
        ends = np.full(len(per), _END, np.uint64)
        u, n = _distinct(np.concatenate([words, ends]), np.concatenate([np.repeat(~out, per), ~out]))
        cuts = _word_parts(u, parts)
        got = []
        for p in range(parts):
            a, b = int(cuts[p]), int(cuts[p + 1])
            if b > a:
                got.append((p, np.array([0, b - a], np.int64).tobytes() + u[a:b].tobytes()
                            + X.squeeze(n[a:b].tobytes())))
        u, n = _distinct(_strings(chunk), _of_training(chunk, out))
        order, cuts = _string_parts(u, parts)
        for p in range(parts):
            rows = order[cuts[p]:cuts[p + 1]]
            if len(rows):
                got.append((parts + p, np.array([1, len(rows)], np.int64).tobytes()
                            + X.squeeze(u[rows].tobytes() + n[rows].tobytes())))
        return got
    return fn


def _sums(keys: np.ndarray, counts: np.ndarray):
    """Distinct keys, their summed counts, and each row's place among the keys."""
    u, place = np.unique(keys, return_inverse=True)
    return u, np.bincount(place, weights=counts, minlength=len(u)), place


def log_probabilities(codes: np.ndarray, counts: np.ndarray, pairs: np.ndarray, order: int = ORDER) -> np.ndarray:
    """log10 P(last byte | ``order`` bytes before) for distinct strings of ``order + 1`` bytes.

    ``codes``, ``counts``: all strings of some groups of equal last two context bytes, with their
    training counts; ``pairs``: training counts of (byte, next byte), 256 x 256.
    """
    sym = (codes & _U(255)).astype(np.int64)
    p = np.ones(len(codes))
    done = np.zeros(len(codes), bool)

    def level(own, total, kinds):
        """Code at one order: own count, all counts and distinct symbols that are not excluded."""
        nonlocal p
        live = ~done & (kinds > 0)
        scale = np.where(live, 2 * total, 1)
        seen = live & (own > 0)
        p = np.where(seen, p * (2 * own - 1) / scale, np.where(live, p * kinds / scale, p))
        done[seen] = True

    # contexts of order..2 bytes; what a longer context has seen is taken out of the shorter one
    key, count, row = codes, counts.astype(np.float64), np.arange(len(codes))
    of = kinds = None
    for k in range(order, 1, -1):
        upper, upper_count = of, count
        key, count, at = _sums(key & _U((1 << 8 * (k + 1)) - 1), count)
        row = at[row]
        contexts, total, of_now = _sums(key >> _U(8), count)
        kinds_now = np.bincount(of_now, weights=count > 0, minlength=len(contexts))
        if upper is None:
            level(count[row], total[of_now[row]], kinds_now[of_now[row]])
        else:
            gone = np.bincount(upper, weights=np.where(upper_count > 0, count[at], 0), minlength=len(kinds))
            level(count[row], total[of_now[row]] - gone[longer], kinds_now[of_now[row]] - kinds[longer])
        of, kinds, longer = of_now, kinds_now, of_now[row]
    # one byte and no byte of context
    c1 = pairs.astype(np.float64)
    c0 = c1.sum(0)
    last = (contexts & _U(255)).astype(np.int64)
    low = last[longer]
    gone1 = np.bincount(of, weights=np.where(count > 0, c1[last[of], (key & _U(255)).astype(np.int64)], 0),
                        minlength=len(last))
    total1, kinds1 = c1.sum(1), (c1 > 0).sum(1).astype(np.float64)
    gone0 = np.where(c1 > 0, c0[None, :], 0).sum(1)
    total0, kinds0 = c0.sum(), float((c0 > 0).sum())
    level(c1[low, sym], total1[low] - gone1[longer], kinds1[low] - kinds[longer])
    level(c0[sym], total0 - gone0[low], kinds0 - kinds1[low])
    p[~done] /= max(256 - kinds0, 1)
    return np.log10(p)


def _facts(pairs: np.ndarray):
    def fn(bodies: list[bytes]) -> list[bytes]:
        """Words: training counts. Strings: log10 probabilities (32-bit)."""
        keys, counts = [], []
        kind = 0
        for body in bodies:
            kind, n = map(int, np.frombuffer(body, np.int64, 2))
            if kind == 0:
                keys.append(np.frombuffer(body, np.uint64, n, 16))
                counts.append(np.frombuffer(X.unsqueeze(body[16 + 8 * n:]), np.uint32))
            else:
                raw = X.unsqueeze(body[16:])
                keys.append(np.frombuffer(raw, np.uint64, n))
                counts.append(np.frombuffer(raw, np.uint32, n, 8 * n))
        u, total, place = _sums(np.concatenate(keys), np.concatenate(counts))
        cuts = np.cumsum([0, *map(len, keys)])
        if kind == 0:
            stats = np.array([total.sum(), (total > 0).sum()], np.int64)
            value = total.astype(np.int64)[place]
        else:
            stats = np.zeros(2, np.int64)
            value = log_probabilities(u, total, pairs)[place].astype(np.float32)
        return [X.squeeze((stats if i == 0 else stats * 0).tobytes() + value[a:b].tobytes())
                for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
    return fn


def _look_up(codes: np.ndarray, u: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Value of each code among the distinct codes u, by a two-level table where that is small."""
    half = _U(8 * (ORDER + 1) // 2)
    hs, ls = np.unique(u >> half), np.unique(u & _U((1 << int(half)) - 1))
    if len(hs) * len(ls) > _DENSE or hs[-1] >= 1 << 20 or ls[-1] >= 1 << 20:
        return value[np.searchsorted(u, codes)]
    rank_h, rank_l = np.zeros(int(hs[-1]) + 1, np.int32), np.zeros(int(ls[-1]) + 1, np.int32)
    rank_h[hs], rank_l[ls] = np.arange(len(hs)), np.arange(len(ls))
    low = _U((1 << int(half)) - 1)
    dense = np.zeros(len(hs) * len(ls), np.float32)
    dense[rank_h[u >> half].astype(np.int64) * len(ls) + rank_l[u & low]] = value
    return dense[rank_h[codes >> half].astype(np.int64) * len(ls) + rank_l[codes & low]]


def _per_doc(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[offs[1:]] - total[offs[:-1]]


def _score(parts: int, mod: int, rest: int, all_tokens: int, kinds: int):
    def fn(chunk, answers):
        out = held_out(chunk, mod, rest)
        words, per = _tokens(chunk)
        u = np.unique(np.concatenate([words, np.full(len(per), _END, np.uint64)]))
        count = np.concatenate([*(np.frombuffer(X.unsqueeze(answers[p])[16:], np.int64)
                                  for p in sorted(answers) if p < parts), np.zeros(0, np.int64)])
        own = count[np.searchsorted(u, words)]
        end = count[np.searchsorted(u, np.array([_END]))[0]]
        bottom = np.log10(all_tokens + kinds + 1)
        offs = np.concatenate([[0], np.cumsum(per)])
        base = _per_doc(np.log10(own + 1.0) - bottom, offs) + np.log10(end + 1.0) - bottom
        known = (_per_doc(own > 0, offs) + (end > 0)).astype(np.int64)
        codes = _strings(chunk)
        u = np.unique(codes)
        order, cuts = _string_parts(u, parts)
        value = np.zeros(len(u), np.float32)
        for p in range(parts):
            if cuts[p + 1] > cuts[p]:
                value[order[cuts[p]:cuts[p + 1]]] = np.frombuffer(X.unsqueeze(answers[parts + p])[16:], np.float32)
        score = _per_doc(_look_up(codes, u, value), _ended(chunk)[1]) if len(codes) else np.zeros(len(per))
        return pa.table({"doc_id": chunk.id_column(), "held_out": pa.array(out),
                         "n_tokens": pa.array(per + 1, pa.int64()), "n_known": pa.array(known, pa.int64()),
                         "train_tokens": pa.array(np.full(len(per), all_tokens, np.int64)),
                         "base_score": pa.array(base), "score": pa.array(score)})
    return fn


def _pair_counts(blobs: DataFrame, mod: int, rest: int) -> np.ndarray:
    """Training counts of (byte, next byte), from partial counts per partition; at most 65,536 rows."""
    def run(batches):
        total = np.zeros(65536, np.int64)
        for batch in batches:
            for chunk in X._rows(batch):
                code = (_strings(chunk, 1).astype(np.int64))[_of_training(chunk, held_out(chunk, mod, rest))]
                total += np.bincount(code, minlength=65536)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["code", "n"])
    out = np.zeros(65536, np.int64)
    for code, n in blobs.mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n")).collect():
        out[code] = n
    return out.reshape(256, 256)


def score(docs: DataFrame, mod: int = 7, rest: int = 2) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per document.

    Learns from documents whose ``crc32(doc_id as text) % mod`` is not ``rest``.
    """
    parts = X.ranges(docs)
    blobs = X.pack(docs)
    pairs = _pair_counts(blobs, mod, rest)
    answers = cut_lineage(X.answer(X.ask(blobs, _ask(parts, mod, rest)), _facts(pairs)))

    def stats(batches):
        total = np.zeros(2, np.int64)
        for batch in batches:
            for body in batch.column("body"):
                total += np.frombuffer(X.unsqueeze(body.as_py())[:16], np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(total[:1]), pa.array(total[1:])], names=["n", "v"])
    n, v = answers.where(F.col("p") < parts).mapInArrow(stats, "n long, v long").agg(F.sum("n"), F.sum("v")).first()
    return X.meet(blobs, answers, _score(parts, mod, rest, n or 0, v or 0),
                  "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                  "base_score double, score double")
