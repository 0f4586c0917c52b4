"""The training-data pipeline: toxicity, near-duplicates, repeated passages, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns the kept documents with the columns of
``documents``; the last one returns packed pieces. Stages are written as Parquet and read
again, so a lost executor repeats one stage at most. Defined results per stage are those of the
operators: null texts are empty and pass, repeated rows stay repeated unless they are
near-duplicates, and an empty table passes through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixspark.llm.common import map_batches, table, texts_of, written
from helixspark.llm.packing import pack_mixture
from helixspark.llm.paragraphs import numbered, without_repeats
from helixspark.llm.secrets import KINDS, find_secrets
from helixspark.llm.setsketch import near_duplicates
from helixspark.llm.spans import replaced
from helixspark.llm.toxicity import learn, score_toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
BATCH_BYTES = 2 << 20


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of a stage. Texts go to and from Python in batches of about ``BATCH_BYTES``, so a
    task's memory does not follow the length of texts (by default a batch is 10,000 rows)."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return docs.select(*COLUMNS)


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows a changed text."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.5 or more go."""
    docs = _documents(docs)
    model = learn(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model, keep=COLUMNS[1:]).where("score < 0.5").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates (five-word shingles, similarity 0.8) stays: that of
    the smallest id, null ids last. Each row is judged by itself, whatever rows share its id."""
    rows = numbered(_documents(docs))
    place = F.struct(F.col("doc_id").isNull().alias("x"), F.col("doc_id").alias("d"), F.col("__row").alias("r"))
    gone = near_duplicates(rows.select(place.alias("place"), "text"), k=5, id_col="place").where("not kept").select(F.col("place.r").alias("__row"))
    return rows.join(gone, "__row", "left_anti").select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All but one occurrence of each repeated passage are cut; documents stay."""
    docs = _documents(docs)
    return _counted(without_repeats(docs))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind in brackets; documents stay."""
    docs = _documents(docs)

    def run(cols):
        out = []
        for t, raw in zip(texts_of(cols["text"]), cols["text"].to_pylist()):
            spans = find_secrets(t)
            out.append(replaced(t, spans, KINDS) if spans else raw)
        return cols | {"text": out}

    return _counted(map_batches(docs, run, docs.schema))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All kept documents as pieces of 1024-token sequences, mixed by source."""
    return pack_mixture(_documents(docs), public_tokenizers.path("byte_bpe_50k.json")).select(
        "doc_id", "source", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "ids")


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("repeated_passages", cut_repeats),
          ("secrets", mask_secrets), ("packing", pack)]

#: No stage is plain SQL (a fitted classifier, sketches, entropy windows, a tokenizer).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
