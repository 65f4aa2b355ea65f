"""Byte-level BPE by corpus-level merge replay.

A task collects the distinct pre-tokens of a run of documents and lays their bytes out in one symbol
array. An inverted index maps the rank of every adjacent pair to its positions; ranks are taken in
order (a heap), each merge is applied at all its positions at once, and only the pairs of the
touched neighbours are looked up and indexed anew. Documents are then encoded by looking up their
pre-tokens. Special tokens do not exist here: their strings are ordinary text. Decoding joins the
ids' byte strings.

Defined results: NULL and empty texts have no tokens (SHA-256 of nothing); any string round-trips.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship
from .exchange import let_go

#: Distinct pre-tokens a task remembers before it starts afresh.
REMEMBER = 200_000
#: Bytes of the documents whose new pre-tokens are replayed together.
RUN_BYTES = 2 << 20


class Ranks:
    """Merge ranks of a vocabulary file (base64 token and rank per line)."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.token: list[bytes] = [b""] * (max(self.rank.values()) + 1)
        for t, r in self.rank.items():
            self.token[r] = t
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        # every pair of tokens that makes a token
        left, right, made = [], [], []
        for t, r in self.rank.items():
            for i in range(1, len(t)):
                a, b = self.rank.get(t[:i]), self.rank.get(t[i:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    made.append(r)
        code = (np.array(left, np.int64) << 20) | np.array(right, np.int64)
        order = np.argsort(code)
        self.code, self.made = code[order], np.array(made, np.int64)[order]

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the token made of a and b, or -1."""
        code = (a << 20) | b
        at = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
        return np.where(self.code[at] == code, self.made[at], -1)


def replay(words: list[bytes], ranks: Ranks) -> list[bytes]:
    """Encode distinct words together; each result is its ids as little-endian 32-bit integers."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size)
    n = int(ends[-1]) if len(words) else 0
    if not n:
        return [b""] * len(words)
    symbol = ranks.byte[np.frombuffer(b"".join(words), np.uint8)]
    after = np.arange(1, n + 1)
    after[ends[size > 0] - 1] = -1
    before = np.arange(-1, n - 1)
    before[(ends - size)[size > 0]] = -1
    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def put(at: np.ndarray) -> None:
        """Index the pairs that begin at these positions."""
        made = ranks.pair(symbol[at], symbol[after[at]])
        ok = made >= 0
        if not ok.any():
            return
        at, made = at[ok], made[ok]
        order = np.argsort(made, kind="stable")
        at, made = at[order], made[order]
        cuts = np.flatnonzero(np.concatenate([[True], made[1:] != made[:-1]]))
        for i, r in enumerate(made[cuts].tolist()):
            part = at[cuts[i]:cuts[i + 1] if i + 1 < len(cuts) else len(at)]
            if r in index:
                index[r].append(part)
            else:
                index[r] = [part]
                heapq.heappush(heap, r)

    put(np.flatnonzero(after >= 0))
    while heap:
        r = heapq.heappop(heap)
        parts = index.pop(r)
        at = np.unique(np.concatenate(parts)) if len(parts) > 1 else np.sort(parts[0])
        # positions may have changed since they were indexed
        at = at[(symbol[at] >= 0) & (after[at] >= 0)]
        if len(at):
            at = at[ranks.pair(symbol[at], symbol[after[at]]) == r]
        if not len(at):
            continue
        if len(at) > 1:
            # in a run of overlapping pairs (x x x) every second one merges, from the left
            chained = np.concatenate([[False], after[at[:-1]] == at[1:]])
            if chained.any():
                place = np.arange(len(at))
                begin = np.maximum.accumulate(np.where(chained, 0, place))
                at = at[(place - begin) % 2 == 0]
        gone = after[at]
        symbol[at] = r
        symbol[gone] = -1
        behind = after[gone]
        after[at] = behind
        has = behind >= 0
        before[behind[has]] = at[has]
        touched = np.concatenate([at[has], before[at][before[at] >= 0]])
        if len(touched):
            put(np.unique(touched))
    alive = np.flatnonzero(symbol >= 0)
    ids = symbol[alive].astype("<u4").tobytes()
    upto = np.concatenate([[0], np.searchsorted(alive, ends)]) * 4
    return [ids[a:b] for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]


class _Numbers(dict):
    """Numbers the words it is asked for, from 0 in order of their first appearance."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


class Encoder:
    """Pre-tokenises documents and keeps the ids of the distinct pre-tokens met so far.

    A document's pre-tokens are held as numbers, so of a run only its distinct ones stay as strings.
    """

    def __init__(self, path: str, pattern: str):
        # white space as Unicode defines it, which leaves out U+001C to U+001F
        self.find = regex.compile(pattern, regex.V0).findall
        self.ranks = Ranks(path)
        self.known, self.coded = _Numbers(), []

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        if len(self.known) > REMEMBER:
            self.known, self.coded = _Numbers(), []
        found = [self._numbers(t) for t in texts]
        self.coded += replay([w.encode() for w in islice(self.known, len(self.coded), None)], self.ranks)
        get = self.coded.__getitem__
        return [b"".join(map(get, f.tolist())) for f in found]

    def _numbers(self, text: str) -> np.ndarray:
        words = self.find(text)
        return np.fromiter(map(self.known.__getitem__, words), np.int32, len(words))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.ranks.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode(docs: DataFrame, path: str, pattern: str, ids: bool = True) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, with ``ids``, ``token_ids`` per document.

    ``path``: the rank file, readable on every executor (part of an installed package).
    """
    ship(docs.sparkSession)

    def run(batches):
        coder = Encoder(path, pattern)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
            at = 0
            while at < len(sizes):
                to, size = at, 0
                while to < len(sizes) and (to == at or size + sizes[to] <= RUN_BYTES):
                    size += sizes[to]
                    to += 1
                # only the texts of this run become Python strings
                coded = coder.encode([t or "" for t in batch.column("text").slice(at, to - at).to_pylist()])
                columns = [batch.column("doc_id").slice(at, to - at),
                           pa.array([len(c) // 4 for c in coded], pa.int64()),
                           pa.array([hashlib.sha256(c).hexdigest() for c in coded], pa.string()),
                           pa.array([hashlib.sha256(coder.decode(c)).hexdigest() for c in coded], pa.string())]
                if ids:
                    columns.append(pa.array([np.frombuffer(c, "<u4").astype(np.int32) for c in coded],
                                            pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=names)
                del coded, columns
                let_go()
                at = to
        del coder
        let_go()

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *(["token_ids"] if ids else [])]
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.col("text").alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
             + (", token_ids array<int>" if ids else ""))
