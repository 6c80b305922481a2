"""A corpus pipeline: language, near copies, benchmark passages, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` stores
the rows of each stage as Parquet in the shared folder and reads them again
as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparksignal.llm.common import small_batches, table
from sparksignal.llm.decontaminate import drop_contaminated
from sparksignal.llm.language_id import UNDETERMINED, identify_languages, learn
from sparksignal.llm.ngram_jaccard import keep_one_of_each_group
from sparksignal.llm.piece_codec import encode_pieces
from sparksignal.llm.queries import held_out, tokenizer_file
from sparksignal.session import cut_lineage


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: NULL texts and texts without a letter."""
    small_batches(spark)
    model = learn(docs.where(~held_out()))
    return identify_languages(docs, model).where(F.col("lang_pred") != UNDETERMINED).select(*docs.columns)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one of least doc_id."""
    small_batches(spark)
    return keep_one_of_each_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages over a twentieth of their words go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every whole text, with digests of the ids and of the text decoded from them."""
    small_batches(spark)
    encoded = encode_pieces(docs, tokenizer_file("piece_bpe_32k.model"))
    return encoded.select(
        "doc_id",
        "n_tokens",
        "ids",
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", identify),
    ("ngram_jaccard", deduplicate),
    ("decontamination", decontaminate),
    ("sentencepiece", encode),
]

#: Language models and tokenizers are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
