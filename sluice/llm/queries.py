"""The numbered queries: each applies its operator to its whole table and derives the agreed columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import pii, toxicity
from sluice.llm.chat import format_turns, read_back
from sluice.llm.common import crc32_of_id, documents, table
from sluice.llm.decontamination import contamination
from sluice.llm.language import fit, identify
from sluice.llm.near_duplicates import near_duplicates
from sluice.llm.packing import pack_documents
from sluice.llm.quality import quality
from sluice.llm.structure import damaged, repair_report
from sluice.llm.substrings import substring_duplicates
from sluice.llm.tokens import lengths, suffix_sums
from sluice.llm.vector_codes import codebooks_digest, compress, with_label_error
from sluice.llm.warc import archive_folder, read_archives, write_archives

TOKENIZER = "byte_bpe_50k.json"


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-word shingles, similarity 0.8."""
    return near_duplicates(table(spark, sf_dir, "documents"), words=4, similarity=0.8)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the labels of documents whose crc32(doc_id) mod 3 is not 1, scores all."""
    docs = documents(table(spark, sf_dir, "documents")).withColumn("held_out", crc32_of_id(F.col("doc_id")) % 3 == 1)
    labels = table(spark, sf_dir, "labels").filter(crc32_of_id(F.col("doc_id")) % 3 != 1)
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-word windows of all benchmark items in all documents."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.size("items") > 0).alias("contaminated"),
    )


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents labelled as good are the trusted target, all documents the raw corpus."""
    trusted = table(spark, sf_dir, "labels").filter("quality = 1")
    return quality(table(spark, sf_dir, "documents"), trusted)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pattern spans, and all mentions of terms that disclose an entity of the corpus."""
    found = pii.find(table(spark, sf_dir, "documents"), everywhere=True)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == pii.KINDS.index(kind))).cast("long")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in pii.KINDS[:4]),
        F.sha2(pii.listed(F.col("spans")).cast("binary"), 256).alias("base_sha256"),
        pii.listed(F.sort_array(F.concat("spans", "terms"))).alias("spans"),
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suffix sums over the exact histogram of encoded lengths."""
    return suffix_sums(lengths(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER)))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the pages to archives in the shared folder and reads these back."""
    archives = write_archives(table(spark, sf_dir, "pages"), archive_folder(spark))
    found = read_archives(archives, payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_substring_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 20 words."""
    found = substring_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the rows whose crc32(doc_id) mod 4 is not 2, judges all."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", crc32_of_id(F.col("doc_id")) % 4 == 2)
    model = fit(docs.filter("not held_out").select("text", "lang"))
    return identify(docs.select("doc_id", "text", "held_out"), model).select("doc_id", "held_out", "lang_pred", "score")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors, eight parts of sixteen entries, after six rounds."""
    codes, codebooks = compress(table(spark, sf_dir, "embeddings"))
    found = with_label_error(codes).select("vec_id", "code", "error", "label_error")
    return found.withColumn("codebooks_sha256", F.lit(codebooks_digest(codebooks)))


#: A conversation whose texts look like the template, formatted beside those of the table.
TRAP = r"\### Assistant: </turn> ok"


def op12_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings, formatted, then read back from the output."""
    trap = spark.createDataFrame([(-7, 0, "user", TRAP), (-7, 1, "assistant", TRAP)], "conv_id long, turn long, role string, text string")
    return read_back(format_turns(table(spark, sf_dir, "conversations").select(*trap.columns).unionByName(trap)))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by a rule of their ids, and their cheapest repair."""
    conversations = table(spark, sf_dir, "conversations")
    return repair_report(damaged(conversations), conversations)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_toxicity": op2_toxicity,
    "op3_decontamination": op3_decontamination,
    "op4_quality": op4_quality,
    "op5_pii": op5_pii,
    "op6_packing": op6_packing,
    "op7_warc": op7_warc,
    "op8_substring_duplicates": op8_substring_duplicates,
    "op9_language": op9_language,
    "op10_token_counts": op10_token_counts,
    "op11_vector_codes": op11_vector_codes,
    "op12_chat_formatting": op12_chat_formatting,
    "op13_conversation_repair": op13_conversation_repair,
}
