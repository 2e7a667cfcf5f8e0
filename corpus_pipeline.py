"""The corpus pipeline: five stages, each a Parquet table that the next one reads.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraweave.llm import bpe_dp, decontaminate, language_id, near_dedup, pii
from terraweave.llm.queries import SURROGATE_KEY, documents, tokenizer_file
from terraweave.llm.tables import stored, table

#: SQL cannot express sketches, surrogates or token ids; tests compare each stage
#: with a brute-force version.
ORACLE_SQL = None


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language, that of their label if they have one.

    Null and empty texts, and texts without letters, go; a null language becomes the
    prediction; rows with null ids are judged alike but teach nothing; repeated rows
    stay repeated; an empty table stays empty, one in which no row has a label raises.
    """
    return language_id.drop_unidentified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least id, of each group of near-duplicates.

    Texts without words are like nothing and stay, as do rows with null ids; rows that
    repeat the id that stays all stay; an empty table stays empty.
    """
    return near_dedup.drop_near_duplicates(docs, words=5, similarity=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark.

    Rows with null ids and null or empty texts stay; all rows of an id go if one of
    them leaks; an empty table, or an empty benchmark, leaves all as it is.
    """
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates in place of personal data, checked for collisions.

    Every row stays; null and empty texts stay as they are, equal texts stay equal. The
    key is the session's setting `spark.terraweave.surrogateKey`, where there is one.
    """
    told = spark.conf.get("spark.terraweave.surrogateKey", None)
    return pii.replace_in_documents(docs, told.encode() if told else SURROGATE_KEY)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, and digests of both ways.

    Every row stays; null and empty texts have no ids; repeated rows are encoded alike.
    """
    encoded = bpe_dp.encode_documents(docs, tokenizer_file("word_bpe_49k.json"))
    return encoded.select(
        "doc_id",
        "n_tokens",
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", identify_languages),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("pii_surrogates", replace_pii),
    ("bpe_encode", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
