"""One query per operator over the whole driver tables, with production parameters, and their SQL twins."""

from __future__ import annotations

import public_tokenizers

from tickerlake.llm import (classifier, fingerprints, jaccard, licenses, manifest, mixing, packing, repeats, rules, sharding, tokencount,
                            tokenfiles, trie)
from tickerlake.llm.common import table
from tickerlake.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

SEQUENCE_TOKENS = 2048
SHARDS = 40
END_TOKEN = 2


def op1_best_fit_packing(spark, d):
    return packing.packed_documents(table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"), SEQUENCE_TOKENS)


def op2_jump_sharding(spark, d):
    return sharding.assign_shards(table(spark, d, "documents"), SHARDS)


def op3_weighted_mixing(spark, d):
    out = mixing.mix(table(spark, d, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "source", "epochs")


def op4_one_permutation_minhash(spark, d):
    return fingerprints.edited_fingerprints(table(spark, d, "documents"))


def op5_quality_classifier(spark, d):
    return classifier.classified(table(spark, d, "documents"), table(spark, d, "labels"))


def op6_ngram_jaccard_join(spark, d):
    out = jaccard.jaccard_components(table(spark, d, "documents"))
    return out.select("doc_id", "n_shingles", "component_id")


def op7_token_counts(spark, d):
    return tokencount.token_counts(table(spark, d, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_license_scan(spark, d):
    out = licenses.license_scan(table(spark, d, "documents"))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")


def op9_repeated_passages(spark, d):
    return repeats.removed_repeats(table(spark, d, "documents"))


def op10_quality_rules(spark, d):
    return rules.quality_rules(table(spark, d, "documents"))


def op11_merkle_manifest(spark, d):
    return manifest.document_manifest(table(spark, d, "documents"))


def op12_token_files(spark, d):
    return tokenfiles.write_tokens(table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"), END_TOKEN).checksums()


def op13_conversation_trie(spark, d):
    return trie.conversation_trie(table(spark, d, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing, op2_jump_sharding, op3_weighted_mixing, op4_one_permutation_minhash, op5_quality_classifier,
    op6_ngram_jaccard_join, op7_token_counts, op8_license_scan, op9_repeated_passages, op10_quality_rules,
    op11_merkle_manifest, op12_token_files, op13_conversation_trie)}

