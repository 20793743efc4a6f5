"""One query per operator over the whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from cinelens.llm import (decontamination, lexical_search, line_dedup, mixing, quality_rules, secrets,
                          sentencepiece_stream, sharding, simhash, site_quality, spelling, token_counts, toxicity)
from cinelens.llm.common import table


def tokenizer_path(name: str) -> str:
    """A file of the public tokenizers: below $TOKENIZERS_DIR if set, else from their package."""
    folder = os.environ.get("TOKENIZERS_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_secret_scans(spark, sf_dir):
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark, sf_dir):
    return line_dedup.digest(table(spark, sf_dir, "documents"))


def op3_sharding(spark, sf_dir):
    return sharding.digest(sharding.shards(table(spark, sf_dir, "documents")))


def op4_sentencepiece(spark, sf_dir):
    encoded = sentencepiece_stream.encode_documents(
        table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"), keep=["doc_id"])
    return encoded.select("row.doc_id", "n_tokens", "ids", "round_trip")


def op5_quality_rules(spark, sf_dir):
    return quality_rules.digest(quality_rules.judge(table(spark, sf_dir, "documents")))


def op6_simhash(spark, sf_dir):
    return simhash.digest(simhash.near_duplicates(table(spark, sf_dir, "documents")))


def op7_quality_classifier(spark, sf_dir):
    """Sources are the hosts; a source's languages are its paths."""
    return site_quality.digest(site_quality.classify(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
        host=F.col("source"), path=F.col("lang")))


def op8_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    chain = toxicity.fit_documents(docs, table(spark, sf_dir, "labels"))
    return toxicity.digest(toxicity.score(docs, chain, keep=["doc_id"]))


def op9_token_counts(spark, sf_dir):
    return token_counts.digest(token_counts.token_counts(
        table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json")))


def op10_decontamination(spark, sf_dir):
    return decontamination.digest(decontamination.scan_benchmark(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op11_lexical_search(spark, sf_dir):
    return lexical_search.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_spelling_variants(spark, sf_dir):
    return spelling.variant_groups(spelling.vocabulary(
        table(spark, sf_dir, "documents"), rule=spelling.deletion_noise()))


def op13_mixing(spark, sf_dir):
    return mixing.digest(mixing.mix(table(spark, sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (
    op1_secret_scans, op2_line_dedup, op3_sharding, op4_sentencepiece, op5_quality_rules,
    op6_simhash, op7_quality_classifier, op8_toxicity, op9_token_counts, op10_decontamination,
    op11_lexical_search, op12_spelling_variants, op13_mixing)}

ORACLE_SQL = {"op2_line_dedup": line_dedup.DIGEST_SQL, "op10_decontamination": decontamination.DIGEST_SQL,
              "op11_lexical_search": lexical_search.DIGEST_SQL, "op13_mixing": mixing.DIGEST_SQL}
