"""A corpus pipeline of five of the operators, each stage over all rows that the one before it kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of ``documents``; the last one returns
token ids beside them.  ``run`` writes every stage as Parquet in the shared folder and reads it again.

Null texts, and empty ones, are rejected by the first stage (fewer than 50 words).  Later stages take them too: texts without
words are one group of near copies, hold no passages and no personal data, stay null where they were, and have no tokens.
Long texts are read as a whole.  Repeated rows are near copies, so one stays; of equal ids any one.  Further columns of any
name stay up to the last stage.  Without rows every stage returns none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chorale.llm.bpe import bpe_encode
from chorale.llm.decontam import find_leaks
from chorale.llm.minhash import deduplicate
from chorale.llm.pii import find_pii, redact
from chorale.llm.quality import apply_rules
from chorale.llm.queries import tokenizer_path
from chorale.llm.shared import mark, quoted, release, table, written


#: The columns that stages work on; others travel in a struct, out of the way of the operators' results.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _packed(docs: DataFrame) -> DataFrame:
    others = [F.col(quoted(c)) for c in docs.columns if c not in COLUMNS] or [F.lit(0).alias("none")]
    return docs.select(*[c for c in COLUMNS if c in docs.columns], F.struct(*others).alias("others"))


def _unpacked(packed: DataFrame, docs: DataFrame) -> DataFrame:
    return packed.select([F.col(c) if c in COLUMNS else F.col("others." + quoted(c)).alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules on hosts that are not rejected."""
    return _unpacked(apply_rules(_packed(docs), every_host=False).where("kept"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id: SimHash links and a similarity of 0.8, on five-word shingles."""
    return deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    found = find_leaks(_packed(docs), table(spark, sf_dir, "benchmark"))
    return _unpacked(found.where(F.size("leaks") == 0), docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind in brackets; n_chars counts the new text."""
    redacted = redact(find_pii(_packed(docs))).withColumn("n_chars", F.length("text").cast("long"))
    return _unpacked(redacted, docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids (little-endian unsigned 32-bit), the number of tokens and the decoded text."""
    return bpe_encode(docs, tokenizer_path()).select(
        "doc_id", "lang", "source", "n_chars", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", "decoded"
    )


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("personal data", personal_data),
    ("BPE tokens", tokens),
]

#: Near copies and merges have no SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows.  What a stage wrote besides its result is deleted, and so is the result that it read."""
    docs, start = table(spark, sf_dir, "documents"), mark()
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        release(spark, start)
    return docs
