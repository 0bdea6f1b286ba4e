"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from . import convtrie, ngramjoin, urlrules
from .common import table
from .convtrie import prefix_trie
from .crosstok import cross_tokenizer
from .golay import near_copies
from .hypershuffle import shard_digest
from .langid import language_table
from .linecrf import line_quality
from .ngramjoin import jaccard_join
from .pfair import interleave
from .qgram import leaked_pairs
from .seekable import token_files
from .surrogates import checked
from .toxfm import toxicity

#: Secret of the registered surrogate query; a real run passes its own.
SURROGATE_KEY = b"key of the registered query"
VOCABULARY = "word_bpe_49k.json"
VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"

QUERIES, ORACLE = {}, {}


def _register(name, sql=None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return wrap


@_register("op1_centroid_language")
def op1(spark, sf_dir):
    return language_table(table(spark, sf_dir, "documents"))


@_register("op2_golay_near_copies")
def op2(spark, sf_dir):
    return near_copies(table(spark, sf_dir, "documents"))


@_register("op3_crf_line_quality")
def op3(spark, sf_dir):
    return line_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_register("op4_surrogates")
def op4(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return checked(docs, SURROGATE_KEY)


@_register("op5_pfair_mix")
def op5(spark, sf_dir):
    return interleave(table(spark, sf_dir, "documents").select("doc_id", "source"))


@_register("op6_hypergeometric_shards")
def op6(spark, sf_dir):
    return shard_digest(table(spark, sf_dir, "documents"))


@_register("op7_factorization_toxicity")
def op7(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_register("op8_seekable_token_files")
def op8(spark, sf_dir):
    import public_tokenizers
    return token_files(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


@_register("op9_url_rules", urlrules.oracle_sql())
def op9(spark, sf_dir):
    return urlrules.judge_urls(table(spark, sf_dir, "pages"))


@_register("op10_qgram_leaks")
def op10(spark, sf_dir):
    return leaked_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), short_items=True)


@_register("op11_cross_tokenizer")
def op11(spark, sf_dir):
    import public_tokenizers
    return cross_tokenizer(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY_A),
                           public_tokenizers.path(VOCABULARY_B))


@_register("op12_conversation_trie", convtrie.oracle_sql())
def op12(spark, sf_dir):
    return prefix_trie(table(spark, sf_dir, "conversations"))


@_register("op13_ngram_jaccard", ngramjoin.oracle_sql())
def op13(spark, sf_dir):
    return jaccard_join(table(spark, sf_dir, "documents"))
