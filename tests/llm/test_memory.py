"""What a worker holds at once stays bounded: Arrow batches by bytes, a run's pre-tokens as numbers."""

import tracemalloc

import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from loanlens.llm import bpe, common

_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def _batch_bytes(spark):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], names=["size"])
    texts = spark.range(0, 300, 1, 1).select(F.repeat(F.lit("abcdefghij"), 10_000).alias("text"))
    return [r.size for r in texts.mapInArrow(run, "size long").collect()]


def test_arrow_batches_are_bounded_by_bytes(spark):
    session = spark.newSession()
    common.ship(session)
    sizes = _batch_bytes(session)
    assert sum(sizes) >= 300 * 100_000 and max(sizes) <= common.ARROW_BYTES + 200_000


def test_a_set_bound_stays(spark):
    session = spark.newSession()
    session.conf.set(_CONF, "3m")
    common.ship(session)
    assert session.conf.get(_CONF) == "3m"


def test_encoder_holds_numbers_not_strings():
    coder = bpe.Encoder(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    texts = [" a b" * 2500] * 100  # 500,000 pre-tokens
    coder.encode(texts[:1])
    tracemalloc.start()
    try:
        ids = coder.encode(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len({*ids}) == 1 and len(ids[0]) == 4 * 5000
    # as strings they took about 30 MB
    assert peak < 10e6
