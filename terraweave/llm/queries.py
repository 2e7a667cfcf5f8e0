"""The opN_<name> queries: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_dp, chat_format, collocations, decontaminate, language_id, near_dedup, packing, pii, resampling, secret_scan, token_counts, token_files, transport_stream
from .tables import shared_path, spread, table


def tokenizer_file(name: str) -> str:
    """Where the public vocabulary files of this machine are."""
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents; those of one fat file are dealt to all cores."""
    return spread(table(spark, sf_dir, "documents"))


def op1_transport_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as a transport stream, read back."""
    streams = transport_stream.store_texts(documents(spark, sf_dir))
    parsed = transport_stream.parse_streams(
        streams.withColumn("media_bytes", F.length("media").cast("long")).withColumn(
            "media_sha256", F.sha2("media", 256)
        ),
        keep=["doc_id", "n_bytes", "media_bytes", "media_sha256"],
    )
    return parsed.select(
        "doc_id",
        "n_bytes",
        F.length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -16, 16)).alias("tail_crc32"),
        "media_bytes",
        "media_sha256",
        "feature",
        "continuity_errors",
    )


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate secret of all documents with the forest's verdict."""
    docs = documents(spark, sf_dir)
    words = [*secret_scan.DICTIONARY, *secret_scan.learned_words(docs)]
    model = secret_scan.fit(secret_scan.labelled_findings(spark), words)
    return secret_scan.scan(docs, model, words=words)


#: The key of surrogates in queries; a real run passes its own secret.
SURROGATE_KEY = b"terraweave query key"


def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced, and what replaced it."""
    return pii.replace_checked(documents(spark, sf_dir), SURROGATE_KEY, keep=["doc_id"])


def op4_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that each document contains."""
    return decontaminate.leaks(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op5_bpe_prefix_dp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    encoded = bpe_dp.encode_documents(
        documents(spark, sf_dir), tokenizer_file("word_bpe_49k.json")
    )
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, written, then read back."""
    folder = token_files.write_token_files(
        documents(spark, sf_dir),
        shared_path(spark, "token-files"),
        tokenizer_file("byte_bpe_50k.json"),
        end_id=2,
    )
    return token_files.crc32_of(token_files.read_token_files(spark, folder))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document."""
    return token_counts.count_tokens(
        documents(spark, sf_dir), tokenizer_file("piece_bpe_32k.model"), limit=4096
    )


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that are similar on two-word shingles."""
    return near_dedup.near_duplicates(documents(spark, sf_dir), words=2, similarity=80)


def op9_chat_windows(spark: SparkSession, sf_dir: str, **options: int) -> DataFrame:
    """All conversations, and one that spells control strings, formatted and read back."""
    added = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(added)
    read = chat_format.read_back(chat_format.format_conversations(talks, **options))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("targets", "")
    return read.select(
        "conv_id",
        "n_turns",
        F.sha2(told, 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from two thirds of the labelled ones."""
    return language_id.identify(documents(spark, sf_dir))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of each language."""
    return collocations.collocations(documents(spark, sf_dir))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, drawn towards the benchmark's words, with all scores."""
    return resampling.resample(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op13_pack_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in sequences of 1024 tokens."""
    pieces = packing.pack_documents(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"), end_id=0)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


QUERIES = {
    "op1_transport_streams": op1_transport_streams,
    "op2_secret_scan": op2_secret_scan,
    "op3_pii_surrogates": op3_pii_surrogates,
    "op4_spaced_seeds": op4_spaced_seeds,
    "op5_bpe_prefix_dp": op5_bpe_prefix_dp,
    "op6_token_files": op6_token_files,
    "op7_token_counts": op7_token_counts,
    "op8_near_dedup": op8_near_dedup,
    "op9_chat_windows": op9_chat_windows,
    "op10_language_id": op10_language_id,
    "op11_collocations": op11_collocations,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_pack_windows": op13_pack_windows,
}

ORACLE_SQL: dict[str, str] = {
    "op4_spaced_seeds": decontaminate.LEAKS_SQL,
    "op8_near_dedup": near_dedup.NEAR_DUPLICATES_SQL,
    "op9_chat_windows": chat_format.chat_sql(),
    "op11_collocations": collocations.COLLOCATIONS_SQL,
    "op12_importance_resampling": resampling.RESAMPLE_SQL,
}
