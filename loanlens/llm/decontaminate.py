"""Benchmark decontamination with a generalised suffix automaton.

The test items' normalised words form one generalised suffix automaton per block of items. Items are dealt
to blocks by hash, about ``BLOCK_WORDS`` words each, and a task builds each block. One block is broadcast
at a time: a benchmark of one block is matched where the documents are; of several, the documents are
packed into chunks, every block makes a pass over them that leaves hit words and items by chunk, and
chunks meet these by id. So neither driver nor worker holds more than one block. Streaming a
document's words keeps the longest match ending at each word; where it reaches the window length,
the last ``window`` words occur in an item and are hit. Items shorter than the window count only as
a whole. Runs of words whose adjacent pairs never meet in any item cannot match and are skipped by a
vectorised test before the automaton is entered.

Defined results: NULL or wordless texts have no words and no hits; items without words have no
window; items without item_id hit like any other, count as one item together and have no name in
``items_sha256``; repeated item_ids are one item with all its rows' windows; repeated documents give a row
each; a kept column named like a result comes as ``doc_<name>``; very long texts are streamed whole.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange as X
from . import textkit as T
from .common import carried, cut_lineage, ship, written

#: Words of the items in one automaton.
BLOCK_WORDS = 400_000

_TABLE = bytes(0x20 if T.ALNUM[b] else T.LOWER[b] for b in range(256))


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TABLE).split()


class Automaton:
    """Generalised suffix automaton over word ids, with the items each state's strings occur in."""

    def __init__(self, items: list[tuple[str, list[int]]], window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        owners: list[set[str]] = [set()]
        whole: list[tuple[int, int, str]] = []
        for name, ids in items:
            last = 0
            for c in ids:
                last = self._extend(last, c, owners)
                owners[last].add(name)
            if ids and len(ids) < window:
                whole.append((last, len(ids), name))
        for state in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            up = self.link[state]
            if up > 0:
                owners[up] |= owners[state]
        # what a match of the window's length names, and which short items end in a state
        self.items = [sorted(owners[s]) if self.length[s] >= window > self.length[max(self.link[s], 0)] else []
                      for s in range(len(self.link))]
        self.short: dict[int, list[tuple[int, str]]] = {}
        for state, n, name in whole:
            self.short.setdefault(state, []).append((n, name))
        # nearest state at or above which has short items
        self.up = [-1] * len(self.link)
        for state in sorted(range(len(self.link)), key=lambda s: self.length[s]):
            self.up[state] = state if state in self.short else (self.up[self.link[state]] if state else -1)

    def _extend(self, last: int, c: int, owners: list[set[str]]) -> int:
        nxt, link, length = self.next, self.link, self.length
        q = nxt[last].get(c)
        if q is not None:
            return q if length[q] == length[last] + 1 else self._split(last, c, q, owners)
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        owners.append(set())
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._split(p, c, q, owners)
        return cur

    def _split(self, p: int, c: int, q: int, owners: list[set[str]]) -> int:
        nxt, link, length = self.next, self.link, self.length
        copy = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        owners.append(set())
        link[q] = copy
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = copy
            p = link[p]
        return copy

    def stream(self, ids: list[int], at: int, hit: np.ndarray, found: set[str], longest: np.ndarray | None) -> None:
        """Follow a run of words that starts at word ``at``; mark hit words and matched items."""
        nxt, link, length, window = self.next, self.link, self.length, self.window
        state, n = 0, 0
        for i, c in enumerate(ids):
            to = nxt[state].get(c)
            while to is None and state:
                state = link[state]
                n = length[state]
                to = nxt[state].get(c)
            if to is None:
                n = 0
                continue
            state, n = to, n + 1
            if longest is not None and n > longest[at + i]:
                longest[at + i] = n
            if n >= window:
                s = state
                while length[link[s]] >= window:
                    s = link[s]
                hit[at + i + 1 - window:at + i + 1] = True
                found.update(self.items[s])
            s = self.up[state]
            while s > 0:
                for size, name in self.short[s]:
                    if n >= size:
                        hit[at + i + 1 - size:at + i + 1] = True
                        found.add(name)
                s = self.up[link[s]] if link[s] >= 0 else -1


class Block:
    """One block of items: vocabulary, adjacent pairs and automaton."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int, shortest: int):
        self.vocabulary: dict[bytes, int] = {}
        coded = [(name, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in ws]) for name, ws in items]
        self.shortest = shortest
        pairs = [np.array(ids[:-1], np.int64) * len(self.vocabulary) + np.array(ids[1:], np.int64)
                 for _, ids in coded if len(ids) > 1]
        self.pairs = np.unique(np.concatenate([*pairs, np.zeros(0, np.int64)]))
        self.automaton = Automaton(coded, window)

    def match(self, ids: np.ndarray, hit: np.ndarray, found: set[str], longest: np.ndarray | None) -> None:
        known = ids >= 0
        if not known.any():
            return
        joined = known[:-1] & known[1:]
        where = np.flatnonzero(joined)
        if len(where) and len(self.pairs):
            code = ids[where] * len(self.vocabulary) + ids[where + 1]
            at = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            joined[where] = self.pairs[at] == code
        else:
            joined[:] = False
        # maximal runs of words joined by known pairs
        edge = np.flatnonzero(np.diff(np.concatenate([[False], joined, [False]]).astype(np.int8)))
        starts, ends = edge[::2], edge[1::2] + 1
        if self.shortest == 1:
            alone = known.copy()
            for a, b in zip(starts, ends, strict=True):
                alone[a:b] = False
            alone = np.flatnonzero(alone)
            starts, ends = np.concatenate([starts, alone]), np.concatenate([ends, alone + 1])
        for a, b in zip(starts, ends, strict=True):
            if b - a >= self.shortest:
                self.automaton.stream(ids[a:b].tolist(), int(a), hit, found, longest)


def blocks(benchmark: DataFrame, window: int) -> DataFrame:
    """The benchmark's items in blocks of about ``BLOCK_WORDS`` words, one pickled block a row: ``g, body``."""
    def count(batches):
        for batch in batches:
            sizes = [n for t in batch.column(0) if (n := len(normal_words(t.as_py())))]
            yield pa.RecordBatch.from_arrays([pa.array([sum(sizes)], pa.int64()),
                                              pa.array([min([window, *sizes])], pa.int64())], names=["n", "least"])

    def build(t: pa.Table) -> pa.Table:
        items = [(name, ws) for name, text in zip(t["item_id"].to_pylist(), t["text"].to_pylist(), strict=True)
                 if (ws := normal_words(text))]
        made = [pickle.dumps(Block(items, window, least), pickle.HIGHEST_PROTOCOL)] if items else []
        return pa.table({"g": t["g"].slice(0, len(made)), "body": pa.array(made, pa.binary())})

    ship(benchmark.sparkSession)
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    words, least = rows.select("text").mapInArrow(count, "n long, least long").agg(F.sum("n"), F.min("least")).first()
    dealt = rows.distinct().withColumn("g", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, -(-(words or 0) // BLOCK_WORDS)))))
    return written(dealt.groupBy("g").applyInArrow(build, "g long, body binary"), "blocks")


_held: dict[int, Block] = {}


def _block(key: int, body) -> Block:
    """The block of a broadcast, unpickled once in a worker, which lets go of the one before."""
    if key not in _held:
        _held.clear()
        _held[key] = pickle.loads(body.value)
    return _held[key]


def _match(block: Block | None, ws: list[bytes]) -> tuple[np.ndarray, set[str], int]:
    """Hit words, matched items and longest match of a document's words in a block."""
    hit, longest, found = np.zeros(len(ws), bool), np.zeros(len(ws), np.int32), set()
    if block is not None:
        ids = np.fromiter(map(block.vocabulary.get, ws, _minus), np.int64, len(ws))
        block.match(ids, hit, found, longest)
    return hit, found, int(longest.max(initial=0))


def _ask_block(p: int, key: int, body):
    """Of a chunk's documents with a match: place, number of hit words and their places, items, longest match."""
    def fn(chunk):
        block, out = _block(key, body), []
        for i in range(len(chunk.ids)):
            raw = chunk.data[int(chunk.offs[i]):int(chunk.offs[i + 1])].tobytes()
            hit, found, longest = _match(block, raw.translate(_TABLE).split())
            if longest:
                out.append((i, np.flatnonzero(hit).astype(np.int32).tobytes(), found, longest))
        return [(p, X.squeeze(pickle.dumps(out, pickle.HIGHEST_PROTOCOL)))]
    return fn


class _Results:
    """Result columns of documents."""

    def __init__(self, per_mille: int, clean: bool):
        self.per_mille, self.clean = per_mille, clean
        self.out = {c: [] for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest_match",
                                    *(["clean_text"] if clean else []))}

    def add(self, raw: bytes, missing: bool, hit: np.ndarray, found: set[str], longest: int) -> None:
        out, n, hits = self.out, len(hit), int(hit.sum())
        out["n_words"].append(n)
        out["n_hit"].append(hits)
        out["n_items"].append(len(found))
        out["items_sha256"].append(hashlib.sha256(",".join(sorted(x for x in found if x is not None)).encode()).hexdigest())
        out["contaminated"].append(hits > 0 and 1000 * hits >= self.per_mille * n)
        out["longest_match"].append(longest)
        if self.clean:
            if hits:
                data = np.frombuffer(raw, np.uint8)
                s, e, _ = T.words(data, np.array([0, len(data)]), T.ALNUM)
                parts, at = [], 0
                for a, b in _spans(hit):
                    parts.append(raw[at:s[a]])
                    at = int(e[b - 1])
                out["clean_text"].append(b"".join([*parts, raw[at:]]).decode())
            else:
                out["clean_text"].append(None if missing else raw.decode())

    def columns(self) -> dict[str, pa.Array]:
        kinds = {"items_sha256": pa.string(), "contaminated": pa.bool_(), "clean_text": pa.string()}
        return {c: pa.array(v, kinds.get(c, pa.int64())) for c, v in self.out.items()}


def _spans(hit: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def scan(docs: DataFrame, benchmark: DataFrame, window: int = 13, coverage: float = 0.05,
         keep: list[str] | None = None, clean: bool = False) -> DataFrame:
    """Per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, longest_match``.

    ``contaminated``: ``n_hit >= coverage * n_words`` with a hit. With ``keep``, those columns of the
    documents come along (renamed by ``carried``); ``longest_match`` is exact from the words of the shortest item on (``window`` at
    most; shorter matches may be missed); with ``clean``, ``clean_text`` is the text without its hit spans (words of
    matched windows and what stands between them).
    """
    sc = docs.sparkSession.sparkContext
    made = blocks(benchmark.select("item_id", "text"), window)
    groups = sorted(r.g for r in made.select("g").collect())
    kept = [c for c in (keep or []) if c != "doc_id"]
    own = [f"_k{i}" for i in range(len(kept))]
    per_mille = round(coverage * 1000)
    types = dict(docs.dtypes)
    schema = ", ".join([f"doc_id {types['doc_id']}", *(f"{o} {types[c]}" for o, c in zip(own, kept, strict=True)),
        "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, longest_match long"]
        + (["clean_text string"] if clean else []))
    results = [*COLUMNS[1:], "longest_match", *(["clean_text"] if clean else [])]
    docs = docs.select("doc_id", F.col("text").alias("_text"), *(F.col(c).alias(o) for o, c in zip(own, kept, strict=True)))

    def named(found: DataFrame) -> DataFrame:
        return found.select("doc_id", *(F.col(o).alias(c) for o, c in zip(own, carried(kept, ["doc_id", *results]), strict=True)),
                            *results)

    def shared(g):
        return sc.broadcast(bytes(made.where(F.col("g") == g).first().body))

    if len(groups) < 2:
        body = shared(groups[0]) if groups else None
        key = body._jbroadcast.id() if groups else -1

        def run(batches):
            block = None if body is None else _block(key, body)
            for batch in batches:
                got = _Results(per_mille, clean)
                for text in batch.column("_text"):
                    raw = (text.as_py() or "").encode()
                    got.add(raw, not text.is_valid, *_match(block, raw.translate(_TABLE).split()))
                columns = got.columns()
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", *own)), *columns.values()],
                                                 names=["doc_id", *own, *columns])
                del got, columns
                X.let_go()
        return named(docs.select("doc_id", *own, "_text").mapInArrow(run, schema))

    packed = docs.select("doc_id", *own, "_text", F.lit(0).alias("_id"), F.col("_text").isNull().alias("_missing"))
    blobs = X.pack(packed, "_id", "_text", ("doc_id", *own, "_missing"))
    asks = None
    for p, g in enumerate(groups):
        body = shared(g)
        got = cut_lineage(X.ask(blobs, _ask_block(p, body._jbroadcast.id(), body)))
        body.destroy()
        asks = got if asks is None else asks.union(got)

    def outcome(chunk, answers):
        n = len(chunk.ids)
        raws = [chunk.data[int(a):int(z)].tobytes() for a, z in zip(chunk.offs[:-1], chunk.offs[1:], strict=True)]
        hit = [np.zeros(len(raw.translate(_TABLE).split()), bool) for raw in raws]
        found, longest = [set() for _ in range(n)], [0] * n
        for answer in answers.values():
            for i, where, names, size in pickle.loads(X.unsqueeze(answer)):
                hit[i][np.frombuffer(where, np.int32)] = True
                found[i] |= names
                longest[i] = max(longest[i], size)
        got, missing = _Results(per_mille, clean), chunk.extra.column("_missing").to_pylist()
        for row in zip(raws, missing, hit, found, longest, strict=True):
            got.add(*row)
        return pa.table({c: chunk.extra.column(c) for c in ("doc_id", *own)} | got.columns())
    return named(X.meet(blobs, asks, outcome, schema))


class _Minus:
    """An endless run of -1, the default of vocabulary look-ups."""

    def __iter__(self):
        return self

    def __next__(self):
        return -1


_minus = _Minus()

COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")

ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
sizes AS (SELECT DISTINCT least(len(w), 13) AS s FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS s,
    array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, s, i, array_to_string(list_slice(w, i, i + s - 1), ' ') AS g
  FROM (SELECT doc_id, s, w, unnest(range(1, len(w) - s + 2)) AS i FROM d, sizes WHERE len(w) >= s)),
m AS (SELECT DISTINCT doc_id, dw.s, i, item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.s = bw.s),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + s)) AS p FROM m) GROUP BY doc_id),
k AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS xs
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM m) GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(xs, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(len(w), 0) AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN k ON d.doc_id = k.doc_id
"""
