"""Corpus pipeline: five stages over the documents table, each calling one training-data operator.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet into the
shared checkpoint folder and reads again as the next stage's documents. All stages but the last
return the columns of documents.

1. quality: documents that the line classifier rejects (score under 0.3) go.
2. near_duplicates: five-word shingles, Jaccard 0.8; of each component the row of smallest doc_id
   stays (of several rows of that id, the one of smallest 64-bit hash; exact repeats are one row).
   Rows of equal doc_id that do not link are separate documents and all stay.
3. repeats: bytes covered by 50-byte strings of a smaller document are cut out; documents of which
   nothing is left go; ``n_chars`` follows the text.
4. decontaminate: documents of which at least 5 % of the words lie in benchmark windows go; from
   the others the words of such windows are cut out, and ``n_chars`` follows the text.
5. tokens: byte-level BPE ids of what is left, with digests of ids and of the decoded bytes.

Documents whose doc_id is NULL have no identity to keep or drop by: stages 2 and 3 leave them as
they are, the others treat them like any document. NULL texts become empty in stage 3.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.llm import bpe, decontaminate, jaccard, quality, repeats
from loanlens.llm.common import cut_lineage, small, table, written

_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = quality.classify(docs, table(spark, sf_dir, "labels"), keep=list(_COLUMNS))
    return scored.where("predicted = 1").select(*_COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # a row's key is a hash of its columns and of which of them are NULL
    key = F.xxhash64(*_COLUMNS, *(F.col(c).isNull() for c in _COLUMNS))
    known = docs.where("doc_id is not null").select(*_COLUMNS, key.alias("_key"))
    found = jaccard.link_components(known.select(F.col("_key").alias("doc_id"), "text"), k=5, num=8, den=10)
    ids = known.groupBy("_key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))
    least = found.select(F.col("doc_id").alias("_key"), "component_id").distinct().join(ids, "_key").groupBy(
        "component_id").agg(F.min(F.struct("doc_id", "_key", "copies")).alias("s"))
    stays = cut_lineage(least.select("s._key", "s.copies"))
    single, copied = stays.where("copies = 1").select("_key"), stays.where("copies > 1").select("_key")
    rows = known.join(small(single), "_key", "left_semi").select(*_COLUMNS)
    if copied.limit(1).count():
        # only exact repeats are shuffled with their texts
        rows = rows.unionByName(known.join(small(copied), "_key", "left_semi").select(*_COLUMNS).distinct())
    return rows.unionByName(docs.where("doc_id is null").select(*_COLUMNS))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = repeats.remove_repeats(docs, keep_text=True, keep=("lang", "source"))
    return cut.where("n_removed = 0 or kept_text <> ''").select(
        "doc_id", F.col("kept_text").alias("text"), "lang", "source",
        F.char_length("kept_text").cast("long").alias("n_chars"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"), keep=["lang", "source", "n_chars"], clean=True)
    size = F.when(F.col("n_hit") > 0, F.char_length("clean_text").cast(docs.schema["n_chars"].dataType))
    return found.where("not contaminated").select(
        "doc_id", F.col("clean_text").alias("text"), "lang", "source", size.otherwise(F.col("n_chars")).alias("n_chars"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality", good_quality), ("near_duplicates", near_duplicates), ("repeats", without_repeats),
          ("decontaminate", decontaminated), ("tokens", tokens)]

#: SQL cannot express the classifier or the merges; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
