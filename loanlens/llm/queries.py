"""Registered queries of the training-data operators and their DuckDB twins.

Each query applies one operator, with its production parameters, to the whole intended table.
"""

from __future__ import annotations

import public_tokenizers

from . import (archives, bpe, chat, decontaminate, forest, jaccard, language, licenses, ppm, quality, repeats, spelling,
               whitening)
from .common import table


def op1_ngram_jaccard_join(spark, sf_dir):
    return jaccard.link_components(table(spark, sf_dir, "documents"), k=3, num=90, den=100)


def op2_arc_to_warc(spark, sf_dir):
    return archives.round_trip(table(spark, sf_dir, "pages")).select(*archives.COLUMNS)


def op3_benchmark_decontamination(spark, sf_dir):
    return decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        *decontaminate.COLUMNS)


def op4_hash_prefix_forest(spark, sf_dir):
    return forest.nearest(table(spark, sf_dir, "embeddings"))


def op5_crf_quality(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_byte_bpe(spark, sf_dir):
    return bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                      public_tokenizers.PATTERN, ids=False)


def op7_chat_prefix_target(spark, sf_dir):
    return chat.query(table(spark, sf_dir, "conversations"))


def op8_license_signatures(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_ppm_language_model(spark, sf_dir):
    return ppm.score(table(spark, sf_dir, "documents"))


def op10_suffix_bucket_dedup(spark, sf_dir):
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), keep_text=False)


def op11_spelling_variants(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_language_id(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_arc_to_warc, op3_benchmark_decontamination, op4_hash_prefix_forest, op5_crf_quality,
    op6_byte_bpe, op7_chat_prefix_target, op8_license_signatures,
    op9_ppm_language_model, op10_suffix_bucket_dedup, op11_spelling_variants, op12_language_id,
    op13_embedding_whitening)}
ORACLE = {"op2_arc_to_warc": archives.ORACLE, "op3_benchmark_decontamination": decontaminate.ORACLE, "op7_chat_prefix_target": chat.ORACLE}
