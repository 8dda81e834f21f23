"""The operators of this subpackage as ``(spark, sf_dir) -> DataFrame``
queries over the whole given tables, with SQL where SQL can express them."""

from __future__ import annotations

from stellate.llm import (decontamination, fingerprints, language_id, mixing, ngram_join, prefix_trie, quality_classifier, quality_rules, sharding,
                          spelling, token_counts, toxicity, warc)
from stellate.llm.common import table


def op9_quality_rules(spark, sf_dir):
    out = quality_rules.quality_cascade(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_decontamination(spark, sf_dir):
    out = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), slop=5)
    return out.drop("text_hash", "items")


def op2_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")


def op4_sharding(spark, sf_dir):
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op7_ngram_join(spark, sf_dir):
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents")).drop("text_hash", "is_first")


def op1_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_quality_classifier(spark, sf_dir):
    return quality_classifier.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_language_id(spark, sf_dir):
    return language_id.identify(table(spark, sf_dir, "documents"))


def op6_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op8_warc(spark, sf_dir):
    out = warc.archive_round_trip(table(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_fingerprints(spark, sf_dir):
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op13_spelling(spark, sf_dir):
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


QUERIES = {
    "op8_warc": op8_warc,
    "op5_language_id": op5_language_id,
    "op6_token_counts": op6_token_counts,
    "op1_toxicity": op1_toxicity,
    "op3_quality_classifier": op3_quality_classifier,
    "op7_ngram_join": op7_ngram_join,
    "op2_mixing": op2_mixing,
    "op4_sharding": op4_sharding,
    "op10_decontamination": op10_decontamination,
    "op9_quality_rules": op9_quality_rules,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_fingerprints": op12_fingerprints,
    "op13_spelling": op13_spelling,
}
ORACLE = {"op10_decontamination": decontamination.ORACLE, "op9_quality_rules": quality_rules.ORACLE, "op11_prefix_trie": prefix_trie.ORACLE,
          "op12_fingerprints": fingerprints.ORACLE, "op13_spelling": spelling.ORACLE}
