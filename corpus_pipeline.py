"""The corpus pipeline: toxicity, line quality, near duplicates, mixing, byte-level BPE.

Each stage takes the documents that the one before kept, reads them from Parquet and returns a
frame. All but the last return the columns of ``documents``; the last returns token ids and what
they decode to, as digests per row.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientbook.llm import bpe, line_crf, minhash, mixing, toxicity
from clientbook.llm.common import table
from clientbook.llm.fitting import training_sample
from clientbook.operators.staging import shared_folder, staged

#: SQL can express neither the two classifiers nor byte-pair merges.
ORACLE_SQL = None

_MARK = "pipeline_mark"


def _by_score(spark: SparkSession, docs: DataFrame, sf_dir: str, module, label: str) -> DataFrame:
    model = module.fit_features(*training_sample(docs, table(spark, sf_dir, "labels"), label, module.features))
    return module.scored(docs, model, _MARK)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the threshold; null and empty texts stay.

    Each row is judged by its own text, so repeated rows and rows without an id go or stay on their own.
    """
    return _by_score(spark, docs, sf_dir, toxicity, "toxic").filter(F.col(_MARK) < toxicity.THRESHOLD).drop(_MARK)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of good quality; null and empty texts score the threshold itself and stay.

    Each row is judged by its own text, so repeated rows and rows without an id go or stay on their own.
    """
    return _by_score(spark, docs, sf_dir, line_crf, "quality").filter(F.col(_MARK) >= line_crf.THRESHOLD).drop(_MARK)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id.

    Rows without an id are kept. Rows that repeat an id and its text are one document. Rows that repeat an id
    with other texts are documents of their own, which come after those whose id is theirs alone.
    """
    marked, repeated = _told_apart(docs)
    gone = staged(
        minhash.near_duplicates(marked.select(F.col(_MARK).alias("doc_id"), "text"))
        .filter("NOT kept")
        .select(F.col("doc_id").alias("pipeline_gone"))
        .distinct()
    )

    def left(rows: DataFrame) -> DataFrame:
        # Only the ids that go are held by a task; whole texts pass it one by one and are not sorted.
        return rows.join(gone.hint("shuffle_hash"), F.col(_MARK) == F.col("pipeline_gone"), "left_anti")

    # A null id is no id: such rows must not be taken for one document.
    named = marked.filter(F.col(_MARK).isNotNull())
    here = F.col("doc_id") == F.col("pipeline_repeated")
    once = left(named.join(repeated, here, "left_anti"))
    again = left(named.join(repeated, here, "left_semi")).dropDuplicates([_MARK])
    unnamed = marked.filter(F.col(_MARK).isNull())
    return once.unionByName(again).unionByName(unnamed).select(*[F.col(f"`{name}`") for name in docs.columns])


def _told_apart(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` with an id per text, and the ids (``pipeline_repeated``) of more than one row.

    The id of a text is the document's own, or one from id and text where its id has several texts.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    repeated = staged(
        docs.filter("doc_id IS NOT NULL")
        .select("doc_id", F.xxhash64(text).alias("hash"))
        .groupBy(F.col("doc_id").alias("pipeline_repeated"))
        .agg(F.count("*").alias("rows"), F.min("hash").alias("least"), F.max("hash").alias("most"))
        .filter("rows > 1")
        .select("pipeline_repeated", F.expr("least <> most").alias("differ"))
    )
    several = staged(repeated.filter("differ").select(F.col("pipeline_repeated").alias("pipeline_several")))
    own = F.xxhash64("doc_id", text).bitwiseAND(F.lit((1 << 61) - 1)) + F.lit(1 << 62)
    mark = F.when(F.col("pipeline_several").isNotNull(), own).otherwise(F.col("doc_id").cast("bigint"))
    marked = docs.join(several, F.col("doc_id") == F.col("pipeline_several"), "left").withColumn(_MARK, mark)
    return marked.drop("pipeline_several"), repeated.select("pipeline_repeated")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; a null source is a source, a null text has no words."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each row; null and empty texts have no ids."""
    return bpe.digests(docs, *bpe.default_table(spark))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
