"""The registered queries of this package and their SQL."""

from __future__ import annotations

from . import (bpe_tree, chat, embed_dedup, exact_dedup, merkle, mixing, packing, quality_gam, sharding, simhash_dedup, suffix_dedup,
               token_align, url_filter)
from .common import read


def op2_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(read(spark, sf_dir, "documents"))


def op4_sharding(spark, sf_dir):
    return sharding.shard_digest(read(spark, sf_dir, "documents"))


def op5_chat_formatting(spark, sf_dir):
    return chat.perspectives(read(spark, sf_dir, "conversations"))


def op6_url_filters(spark, sf_dir):
    return url_filter.judge(read(spark, sf_dir, "pages"))


def op8_mixing(spark, sf_dir):
    return mixing.mix_digest(read(spark, sf_dir, "documents"))


def op10_simhash(spark, sf_dir):
    return simhash_dedup.simhash_digest(read(spark, sf_dir, "documents"))


def op3_quality_classifier(spark, sf_dir):
    return quality_gam.quality_digest(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_packing(spark, sf_dir):
    return packing.pack_digest(read(spark, sf_dir, "documents"))


def op1_suffix_dedup(spark, sf_dir):
    return suffix_dedup.suffix_digest(read(spark, sf_dir, "documents"))


def op7_embedding_dedup(spark, sf_dir):
    return embed_dedup.embedding_groups(read(spark, sf_dir, "embeddings"))


def op11_bpe_tree(spark, sf_dir):
    return bpe_tree.codec_digest(read(spark, sf_dir, "documents"))


def op12_token_align(spark, sf_dir):
    return token_align.align_digest(read(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark, sf_dir):
    return merkle.manifest_digest(read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op2_exact_dedup, op4_sharding, op5_chat_formatting, op6_url_filters, op8_mixing,
                                  op10_simhash, op3_quality_classifier, op9_packing,
                                  op1_suffix_dedup, op7_embedding_dedup, op11_bpe_tree, op12_token_align, op13_merkle_manifest)}
ORACLE = {"op2_exact_dedup": exact_dedup.ORACLE, "op5_chat_formatting": chat.ORACLE, "op13_merkle_manifest": merkle.ORACLE}
