"""A training-data pipeline over ``documents``, built from the operators in cinelens/llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All stages but
the last return the columns of ``docs``:

1. toxicity: rejected documents go;
2. line dedup: lines shared with a smaller doc_id go from the text;
3. SimHash near-dedup: of every group only the smallest doc_id stays;
4. benchmark decontamination: documents with a benchmark passage go;
5. SentencePiece: every text becomes token ids.

``run(spark, sf_dir)`` applies all of them to ``documents``. The outcome rests
on a trained classifier, XXH64 fingerprints and a tokenizer file, so no SQL
can express it; tests hold it against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelens.llm import (decontamination, line_dedup, sentencepiece_stream, simhash, toxicity)
from cinelens.llm.common import shared_folder, table
from cinelens.llm.queries import tokenizer_path

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain (operator 8) does not reject."""
    chain = toxicity.fit_documents(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, chain)
    clean = scored.where(F.col("p_toxic") < toxicity.THRESHOLD)
    return clean.select([F.col("row").getField(c).alias(c) for c in docs.columns])


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that operator 2 drops; n_chars follows the text.

    A text that loses no line is left as it is (null stays null).
    """
    kept = line_dedup.keep_lines(docs, line_dedup.keep_bitmaps(docs))
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("text"))
        elif c == "n_chars":
            kind = docs.schema[c].dataType
            columns.append(F.when(F.col("n_dropped") > 0, F.char_length("text").cast(kind))
                           .otherwise(F.col("row").getField(c)).alias(c))
        else:
            columns.append(F.col("row").getField(c).alias(c))
    return kept.select(columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of operator 6: the smallest doc_id.

    Of rows sharing that id (or of a group without ids) the one with the smallest hash of its
    columns stays; of rows equal in every column, one.
    """
    return simhash.representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of any benchmark item (operator 10)."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and ids of every document (operator 4)."""
    encoded = sentencepiece_stream.encode_documents(
        docs, tokenizer_path("piece_bpe_32k.model"),
        keep=[c for c in ("doc_id", "lang", "source") if c in docs.columns])
    return encoded.select("row.*", "n_tokens", "ids", "round_trip")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; results between stages are written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            path = shared_folder(spark, f"stage-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
