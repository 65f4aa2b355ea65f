"""Suffix-array dedup by bucket-pointer refinement.

Suffixes start in buckets of their first ``Q`` bytes. A bucket is refined by sorting on the bucket
identifiers of later offsets: the buckets at p, p + 20 and p + 30 give p's 50-byte bucket, and the
50-byte buckets at both ends of a run of suffixes give the run's bucket; each refinement reuses
the identifiers of the one before. Only buckets that still hold different documents are refined.

Which suffixes lead a run is decided by content: in every 50-byte window the suffix with the least
bucket hash leads, so equal windows in two documents have the same leader, and a run is the set of
adjacent windows that one suffix leads. Round one sorts run buckets (about one per sixteen bytes)
over the corpus; a run whose bucket also lies in a smaller document is removed whole. Round two
takes, of leaders with several different runs, the first document's windows one by one; a run that
occurs again under the same doc_id has the outcome of its first occurrence. So every window of 50
bytes is decided exactly (up to 64-bit identifiers), and nothing is sampled or capped.

Defined results: NULL and empty texts have no bytes; texts under 50 bytes stay whole; documents with
equal doc_id never remove from each other; rows with a NULL doc_id stay whole and remove nothing; an empty
table gives no rows; a very long text is a chunk of its own; a kept column named like a result comes as ``doc_<name>``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange as X
from . import textkit as T
from .common import carried, cut_lineage

_U = np.uint64
WIDTH = 50
Q = 20
_SPAN = WIDTH - Q + 1
_PIECE = (1 << 20) - 64
_POS = 24
_K = [_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9), _U(0x27D4EB2F165667C5)]


def _bucket50(b: np.ndarray, p: np.ndarray) -> np.ndarray:
    """50-byte bucket of the suffixes at p from the Q-byte buckets at p, p + 20 and p + 30."""
    return T.mix64(b[p] * _K[0] + b[p + Q] * _K[1] + b[p + WIDTH - Q] * _K[2])


class Runs:
    """Runs of windows led by one suffix, over all documents of a chunk (piece by piece)."""

    def __init__(self, chunk: X.Chunk):
        data, offs = chunk.data, chunk.offs
        size = np.diff(offs)
        usable = (size >= WIDTH) & ~chunk.missing
        last = np.where(usable, offs[1:] - WIDTH, offs[:-1] - 1)  # last window start
        lead, run, first, count, doc = [], [], [], [], []
        n = len(data)
        self.pieces = []
        for s in range(0, max(n - WIDTH + 1, 0), _PIECE):
            e = min(n, s + _PIECE + WIDTH - 1)
            pre = T.prefix_hash(data[s:e])
            at = np.arange(e - s - Q + 1)
            b = T.span_hash(pre, at, at + Q)
            m = ((b >> _U(_POS)) << _U(_POS)) | at.astype(np.uint64)
            for step in (1, 2, 4, 8):
                m = np.minimum(m[:-step], m[step:])
            m = np.minimum(m[:len(m) - (_SPAN - 16)], m[_SPAN - 16:])
            who = (m & _U((1 << _POS) - 1)).astype(np.int64)
            windows = len(who)
            # windows inside one usable document
            ok = np.zeros(windows + 1, np.int32)
            a, z = np.clip(offs[:-1] - s, 0, windows), np.clip(last + 1 - s, 0, windows)
            has = usable & (a < z)
            np.add.at(ok, a[has], 1)
            np.add.at(ok, z[has], -1)
            ok = np.cumsum(ok[:-1]) > 0
            cut = np.ones(windows, bool)
            cut[1:] = (who[1:] != who[:-1]) | ~ok[:-1]
            cut[a[has]] = True
            starts = np.flatnonzero(cut & ok)
            if not len(starts):
                continue
            ends = np.flatnonzero(ok & np.concatenate([cut[1:] | ~ok[1:], [True]]))
            anchor = who[starts]
            # leaders are the least hashes of their windows: mixed again, they spread over the ranges
            lead.append(T.mix64(b[anchor] ^ _K[3]))
            run.append(T.mix64(_bucket50(b, starts) * _K[0] + _bucket50(b, ends) * _K[1]
                               + (anchor - starts).astype(np.uint64) * _K[2]
                               + (ends - starts).astype(np.uint64) * _K[3]))
            first.append(starts + s)
            count.append(ends - starts + 1)
            doc.append(np.searchsorted(offs, starts + s, side="right") - 1)
        none = np.zeros(0, np.int64)
        self.lead, self.run = (np.concatenate([*x, none.astype(np.uint64)]) for x in (lead, run))
        self.first, self.count, self.doc = (np.concatenate([*x, none]) for x in (first, count, doc))
        self.data = data

    def windows(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and 50-byte bucket of every window of these runs."""
        count = self.count[runs]
        p = np.repeat(self.first[runs], count) + (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
        out = np.empty(len(p), np.uint64)
        for s in range(0, len(self.data), _PIECE):
            here = (p >= s) & (p < s + _PIECE)
            if not here.any():
                continue
            pre = T.prefix_hash(self.data[s:s + _PIECE + WIDTH])
            at = p[here] - s
            b = [T.span_hash(pre, at + o, at + o + Q) for o in (0, Q, WIDTH - Q)]
            out[here] = T.mix64(b[0] * _K[0] + b[1] * _K[1] + b[2] * _K[2])
        return p, out


def _least(keys: list[np.ndarray], ids: np.ndarray):
    """Rows sorted by keys then id; where each key's rows begin; each row's place among the keys."""
    order = np.lexsort((ids, *reversed(keys)))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    return order, np.flatnonzero(new), np.cumsum(new) - 1


def _bodies(kind: int, key: np.ndarray, extra: np.ndarray | None, ids: np.ndarray, parts: int):
    """Entries split by the key's top bits; within a range ordered by document id. -> order, cuts, bodies"""
    part = ((key >> _U(48)) * _U(parts) >> _U(16)).astype(np.int64)
    order = np.lexsort((ids, part))
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    out = []
    for p in range(parts):
        rows = order[cuts[p]:cuts[p + 1]]
        if not len(rows):
            continue
        who, per = np.unique(ids[rows], return_counts=True)
        head = X.squeeze(who.tobytes() + per.astype(np.int64).tobytes())
        body = key[rows].tobytes() if extra is None else (
            (key[rows] >> _U(16)).astype(np.uint32).tobytes() + extra[rows].tobytes())
        out.append((p + kind * parts, np.array([kind, len(rows), len(who), len(head)], np.int64).tobytes() + head + body))
    return order, cuts, out


def _entries(runs: Runs, ids: np.ndarray):
    """Distinct (lead, run) buckets of a chunk with their smallest document."""
    order, begin, place = _least([runs.lead, runs.run], ids[runs.doc])
    firsts = order[begin]
    entry = np.empty(len(order), np.int64)
    entry[order] = place
    return firsts, entry


def _ask_runs(parts: int):
    def fn(chunk):
        runs = Runs(chunk)
        firsts, _ = _entries(runs, chunk.ids)
        return _bodies(0, runs.lead[firsts], runs.run[firsts], chunk.ids[runs.doc[firsts]], parts)[2]
    return fn


def _refine(bodies: list[bytes]) -> list[bytes]:
    """Bit 1: a smaller document has the same bucket. Bit 2: first of a bucket whose leader has other buckets."""
    kinds, keys, extras, ids = set(), [], [], []
    for body in bodies:
        kind, n, docs, head = np.frombuffer(body, np.int64, 4)
        kinds.add(int(kind))
        raw = np.frombuffer(X.unsqueeze(body[32:32 + head]), np.int64)
        ids.append(np.repeat(raw[:docs], raw[docs:]))
        at = 32 + int(head)
        if kind == 0:
            keys.append(np.frombuffer(body, np.uint32, n, at))
            extras.append(np.frombuffer(body, np.uint64, n, at + 4 * int(n)))
        else:
            keys.append(np.frombuffer(body, np.uint64, n, at))
    cuts = np.cumsum([0, *map(len, keys)])
    key, who = np.concatenate(keys), np.concatenate(ids)
    flags = np.zeros(len(key), np.uint8)
    if kinds == {0}:
        extra = np.concatenate(extras)
        order, begin, place = _least([key, extra], who)
        least = who[order[begin]]
        lead = key[order[begin]]
        several = np.zeros(len(lead), bool)
        same = lead[1:] == lead[:-1]
        several[1:] |= same
        several[:-1] |= same
        smaller = who[order] > least[place]
        flags[order] = smaller | ((several[place] & ~smaller).astype(np.uint8) << 1)
    else:
        order, begin, place = _least([key], who)
        flags[order] = who[order] > who[order[begin]][place]
    return [X.squeeze(flags[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _flags(answers: dict[int, bytes], kind: int, parts: int, order: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(order), np.uint8)
    for p in range(parts):
        if cuts[p + 1] > cuts[p]:
            out[order[cuts[p]:cuts[p + 1]]] = np.frombuffer(X.unsqueeze(answers[p + kind * parts]), np.uint8)
    return out


def _judge_runs(chunk: X.Chunk, answers: dict[int, bytes], parts: int):
    """The chunk's runs, which are removed whole, the windows of those that must be looked at window by window
    (one run of each bucket), and the runs of the same buckets and documents that share their outcome."""
    runs = Runs(chunk)
    firsts, entry = _entries(runs, chunk.ids)
    order, cuts, _ = _bodies(0, runs.lead[firsts], runs.run[firsts], chunk.ids[runs.doc[firsts]], parts)
    flags = _flags(answers, 0, parts, order, cuts)
    whole = (flags[entry] & 1 > 0) | (chunk.ids[runs.doc] > chunk.ids[runs.doc[firsts]][entry])
    looked = flags & 2 > 0
    single = firsts[looked]
    p, bucket = runs.windows(single)
    ids = np.repeat(chunk.ids[runs.doc[single]], runs.count[single])
    # other occurrences in the same document, or in other rows of its doc_id: equal bytes, equal outcome
    more = looked[entry] & ~whole
    more[single] = False
    more = np.flatnonzero(more)
    begin = np.cumsum(runs.count[single]) - runs.count[single]
    model = begin[np.cumsum(looked)[entry[more]] - 1]
    return runs, whole, p, bucket, ids, more, model


def _ask_windows(parts: int):
    def fn(chunk, answers):
        _, _, _, bucket, ids, _, _ = _judge_runs(chunk, answers, parts)
        order, begin, _ = _least([bucket], ids)
        firsts = order[begin]
        got = _bodies(1, bucket[firsts], None, ids[firsts], parts)[2]
        return pa.table({"p": pa.array([p for p, _ in got], pa.int32()),
                         "bid": pa.array([chunk.bid] * len(got), pa.int64()),
                         "body": pa.array([b for _, b in got], pa.binary())})
    return fn


def _outcome(parts: int, keep_text: bool, keep: tuple[str, ...]):
    def fn(chunk, answers):
        runs, whole, p, bucket, ids, more, model = _judge_runs(chunk, answers, parts)
        edge = np.zeros(len(chunk.data) + 1, np.int32)
        np.add.at(edge, runs.first[whole], 1)
        np.add.at(edge, runs.first[whole] + runs.count[whole] + WIDTH - 1, -1)
        if len(p):
            order, begin, place = _least([bucket], ids)
            firsts = order[begin]
            o, cuts, _ = _bodies(1, bucket[firsts], None, ids[firsts], parts)
            flags = _flags(answers, 1, parts, o, cuts)
            hit = np.empty(len(p), bool)
            hit[order] = (flags[place] > 0) | (ids[order] > ids[firsts][place])
            np.add.at(edge, p[hit], 1)
            np.add.at(edge, p[hit] + WIDTH, -1)
            before = np.concatenate([[0], np.cumsum(hit)])
            some = before[model + runs.count[more]] > before[model]
            more, model = more[some], model[some]
            count = runs.count[more]
            step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            again = hit[np.repeat(model, count) + step]
            again = (np.repeat(runs.first[more], count) + step)[again]
            np.add.at(edge, again, 1)
            np.add.at(edge, again + WIDTH, -1)
        gone = np.cumsum(edge[:-1], out=edge[:-1]) > 0
        del edge
        out = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")}
        texts = []
        for i in range(len(chunk.ids)):
            a, z = int(chunk.offs[i]), int(chunk.offs[i + 1])
            own, data = gone[a:z], chunk.data[a:z]
            kept = data[~own].tobytes()
            out["n_bytes"].append(z - a)
            out["n_removed"].append(int(own.sum()))
            out["n_spans"].append(int(own[:1].sum() + (own[1:] & ~own[:-1]).sum()))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            if keep_text:
                texts.append(kept.decode(errors="ignore"))
        cols = {"doc_id": chunk.id_column(), **{c: pa.array(v, pa.int64()) for c, v in out.items() if c[0] == "n"},
                "kept_sha256": pa.array(out["kept_sha256"], pa.string())}
        if keep_text:
            cols["kept_text"] = pa.array(texts, pa.string())
        cols |= {c: chunk.extra.column(c) for c in keep}
        return pa.table(cols)
    return fn


def remove_repeats(docs: DataFrame, keep_text: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Remove every byte covered by a 50-byte string that also starts in a document of smaller doc_id.

    ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` (of the remaining bytes) and, with
    ``keep_text``, ``kept_text``: the remaining bytes without characters cut in the middle. The
    columns ``keep`` of the documents come along (``doc_<name>`` where a result has that name).
    """
    parts = X.ranges(docs)
    types = dict(docs.dtypes)
    own = tuple(f"_k{i}" for i in range(len(keep)))
    results = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept_text"] if keep_text else [])]
    names = carried(keep, results)
    blobs = X.pack(docs.select("doc_id", "text", *(F.col(c).alias(o) for o, c in zip(own, keep, strict=True))), carry=own)
    one = cut_lineage(X.answer(X.ask(blobs, _ask_runs(parts)), _refine))
    # a chunk without any run asks nothing and still has to come out, hence the empty answer
    every = blobs.select(F.lit(-1).alias("p"), "bid", F.lit(b"").alias("body"))
    two = X.answer(X.meet(blobs, one, _ask_windows(parts), X.ASK), _refine)
    schema = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
              + (", kept_text string" if keep_text else "") + "".join(f", {o} {types[c]}" for o, c in zip(own, keep, strict=True)))
    found = X.meet(blobs, one.union(two).union(every), _outcome(parts, keep_text, own), schema)
    return found.select(*results, *(F.col(o).alias(c) for o, c in zip(own, names, strict=True)))
