"""Ask-and-answer exchange between chunks of documents and a corpus-wide hash space.

Several operators need, for every token of every document, one fact about the whole corpus (its
frequency, whether it occurs elsewhere). Shipping a row per token would shuffle many times the
input. Here documents are packed into chunks of a few megabytes; each chunk *asks* once for every
distinct token, as one packed array per hash range; a hash range *answers* all chunks; and each
chunk meets its answers again by its id. Spark partitions, shuffles and retries all of it; Python
sees one chunk or one hash range at a time, both of bounded size. A token that a third of all
documents hold is asked once per chunk, so no hash range is hot.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit
from .common import cut_lineage, ship

PACK_BYTES = 6 << 20
_PACKED = "bid long, n int, body binary, extra binary"
ASK = "p int, bid long, body binary"


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def let_go() -> None:
    """Give freed memory back: workers outlive a stage, and what they keep adds to the next one's."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def squeeze(data: bytes) -> bytes:
    """zstd, with the plain length in front."""
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unsqueeze(data: bytes) -> bytes:
    n = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], decompressed_size=n, codec="zstd", asbytes=True) if n else b""


@dataclass
class Chunk:
    bid: int
    ids: np.ndarray      # int64
    missing: np.ndarray  # bool, id is NULL
    data: np.ndarray     # uint8, all texts
    offs: np.ndarray     # int64, one more than documents
    extra: pa.RecordBatch | None = None  # columns that came along

    def id_column(self) -> pa.Array:
        return pa.array(self.ids, pa.int64(), mask=self.missing)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Documents packed into compressed chunks, checkpointed. NULL texts are empty, NULL ids kept.

    The columns ``carry`` travel with the chunk.
    """
    names = [f"c{i}" for i in range(len(carry))]

    def extra(batch, i, n):
        if not carry:
            return None
        part = pa.RecordBatch.from_arrays([batch.column(2 + j).slice(i, n) for j in range(len(carry))],
                                          names=list(carry))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, part.schema) as out:
            out.write_batch(part)
        return squeeze(sink.getvalue().to_pybytes())

    def run(batches):
        base, seq = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            ids = batch.column(0)
            missing = np.asarray(ids.is_null())
            ids = np.asarray(ids.fill_null(0))
            for i, data, offs in textkit.chunks(batch.column(1), PACK_BYTES):
                n = len(offs) - 1
                body = b"".join((ids[i:i + n].tobytes(), missing[i:i + n].tobytes(), offs.tobytes(),
                                 data.tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([base + seq]), pa.array([n], pa.int32()), pa.array([squeeze(body)], pa.binary()),
                     pa.array([extra(batch, i, n)], pa.binary())], names=["bid", "n", "body", "extra"])
                seq += 1
    ship(docs.sparkSession)
    return cut_lineage(docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"),
                                   *(F.col(c).alias(n) for c, n in zip(carry, names, strict=True)))
                       .mapInArrow(run, _PACKED))


def _chunk(bid: int, n: int, body: bytes, extra: bytes | None) -> Chunk:
    raw = np.frombuffer(unsqueeze(body), np.uint8)
    at = 8 * n
    ids, missing = raw[:at].view(np.int64), raw[at:at + n].view(bool)
    at += n
    offs = np.frombuffer(raw[at:at + 8 * (n + 1)].tobytes(), np.int64)
    more = pa.ipc.open_stream(unsqueeze(extra)).read_next_batch() if extra else None
    return Chunk(bid, ids, missing, raw[at + 8 * (n + 1):], offs, more)


def _rows(batch):
    for row in zip(*(batch.column(c) for c in ("bid", "n", "body", "extra")), strict=True):
        yield _chunk(*(x.as_py() for x in row))
        let_go()


def ask(blobs: DataFrame, fn: Callable[[Chunk], list[tuple[int, bytes]]]) -> DataFrame:
    """One row (p, bid, body) for each hash range ``p`` and chunk."""
    def run(batches):
        for batch in batches:
            for chunk in _rows(batch):
                got = fn(chunk)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p for p, _ in got], pa.int32()), pa.array([chunk.bid] * len(got), pa.int64()),
                     pa.array([b for _, b in got], pa.binary())], names=["p", "bid", "body"])
    return blobs.mapInArrow(run, ASK)


def answer(asks: DataFrame, fn: Callable[[list[bytes]], list[bytes]]) -> DataFrame:
    """Per hash range: the bodies of all chunks -> one answer for each, in the same order."""
    def run(t: pa.Table) -> pa.Table:
        out = pa.table({"p": t["p"], "bid": t["bid"],
                        "body": pa.array(fn(t["body"].to_pylist()), pa.binary())})
        let_go()
        return out
    return asks.groupBy("p").applyInArrow(run, ASK)


def meet(blobs: DataFrame, answers: DataFrame, fn: Callable[[Chunk, dict[int, bytes]], pa.Table],
         schema: str) -> DataFrame:
    """Every chunk with its answers by hash range."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        got = dict(zip(right["p"].to_pylist(), right["body"].to_pylist(), strict=True))
        out = pa.concat_tables([fn(c, got) for b in left.to_batches() for c in _rows(b)])
        let_go()
        return out
    return blobs.groupBy("bid").cogroup(answers.groupBy("bid")).applyInArrow(run, schema)


def ranges(df: DataFrame) -> int:
    """Hash ranges for a corpus: as many as shuffle partitions, which follow the input's size."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
