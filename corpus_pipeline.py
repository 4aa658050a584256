"""A corpus pipeline over ``documents``: language ID, near duplicates, repeated passages,
benchmark decontamination, packing. Each stage calls one operator of ``strata.llm`` on all that the
stage before it kept; all but the last return the columns of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import cut, table
from strata.llm.decontam import without_leaks
from strata.llm.jaccard import jaccard_components
from strata.llm.langid import fit, held_out, predict
from strata.llm.packing import pack
from strata.llm.queries import tokenizer_path
from strata.llm.substring import remove_repeats

DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]
# Texts in two languages stay: only where no language stands out a document is rejected.
LEAST_CONFIDENCE = 0.3


def _documents(docs: DataFrame, text: Column | None = None) -> DataFrame:
    if text is None:
        return docs.select(*DOCUMENT)
    return docs.select("doc_id", text.alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: a null text, one without a letter, and one whose best language has a
    calibrated probability below ``LEAST_CONFIDENCE`` go. Where no row has a language to learn from,
    texts with a letter stay."""
    model = fit(docs.where(F.col("doc_id").isNotNull() & ~held_out(3, 1)))
    if model is None:
        return _documents(docs.where(F.col("text").rlike("\\p{L}")))
    told = predict(_documents(docs), model)
    return _documents(told.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_CONFIDENCE)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, Jaccard similarity of 0.8 or
    more, linked transitively): that of the smallest doc_id. Texts without words and null ids stay;
    rows that share a doc_id are one document and stay or go together."""
    gone = (jaccard_components(docs, percent=80, w=5).where("component_id <> doc_id").select(F.col("doc_id").alias("_gone")).distinct())
    # the copies grow with the documents: the same join at every size
    return _documents(docs.join(gone.hint("merge"), docs.doc_id == gone["_gone"], "left_anti"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of passages that a smaller doc_id has; texts that lose nothing stay as
    they are, and documents that lose every word go."""
    told = remove_repeats(_documents(docs))
    text = F.when(F.col("_n_removed") > 0, F.col("_kept")).otherwise(F.col("text"))
    return _documents(told.where((F.col("_n_removed") == 0) | (F.col("_n_removed") < F.col("_n_words"))), text)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_leaks(_documents(docs), table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 4096 tokens."""
    pieces = pack(docs, tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
          ("decontaminate", decontaminate), ("pack", pack_sequences)]

# A learned language model and a tokenizer are among the stages; SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    # whole texts go to Python workers a few MB at a time (the default is 10,000 rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, f"pipeline-{name}")
    return docs
