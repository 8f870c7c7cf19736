"""A corpus from raw documents to pieces: five stages, each on all that the one before it kept.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which ``run`` writes as Parquet and reads
again for the next.  All but the last return the columns of ``documents``.

- toxicity: documents that the classifier scores at 0.5 or more go;
- near_dedup: of each group of near-duplicates, five-word shingles at a similarity of 0.8, the document with
  the smallest id stays, and of rows that repeat it that with the smallest MD5 of its text;
- decontaminate: documents into which a benchmark item leaks go;
- pii: personal data in the texts is replaced by its kind, and ``n_chars`` follows;
- sentencepiece: the pieces of every text, their byte spans, and what they decode to.

Cases: a null text is an empty one to every stage and stays null until the last; such rows, and rows without an id,
are no near-duplicates and stay.  Rows that repeat an id are judged each by its own text by all stages but
decontaminate, which reports a leak by its id and drops all rows of it.  Further columns are left out by the first
stage.  Empty tables, of documents, labels or benchmark, give empty results or drop nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hivelake.llm import decontaminate, minmax_dedup, pii_crf, sentencepiece_codec, toxicity
from hivelake.llm._scratch import new_path, remove, scratch, written
from hivelake.llm._workers import importable
from hivelake.llm.queries import PIECES, table, tokenizer

#: No SQL states the classifier, the field or the pieces.
ORACLE_SQL = None

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A similarity, in hundredths, from which documents are near-duplicates.
SIMILARITY = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select(*COLUMNS), model, into="__score").where(F.col("__score") < 0.5).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return minmax_dedup.without_duplicates(docs.select(*COLUMNS), percent=SIMILARITY)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return pii_crf.redact(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids, starts, ends, decoded)`` of every document."""
    importable(spark)
    encoded = sentencepiece_codec.encode(docs, tokenizer(PIECES), decoded=True)  # one worker a task for both
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "starts", "ends", "decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("pii", redact),
    ("sentencepiece", pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, name)
        with scratch(spark):
            out = written(stage(spark, docs, sf_dir), name, path=path)
        remove(docs)
        docs = out
    return docs
