"""Mixing sources to target weights.

Words are counted per source, a target is set for each source, and every document is repeated
``floor(rate)`` times plus one more copy with a probability equal to the fraction of its
source's rate (target / size). The extra copy is decided by a hash of the seed and the document
id, so reruns agree and rows need no shuffling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clientbook.llm.common import table, uniform, words_in
from clientbook.operators.staging import staged

WEIGHTS = (5, 2, 1)
SEED = "mix"


def source_targets(
    documents: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    percent: int = 150,
    most_repeats: int = 2,
) -> DataFrame:
    """(source, source_size, target): one row per source.

    Sources sorted by code point, null last, take the weights in turn. They share ``percent``
    of all words by weight; a target stops at ``most_repeats`` times its source's words and the
    excess is shared by the others. With sources in order of capacity per weight, a source
    is full exactly if its capacity is at most its share of what the sources before it leave;
    that gives the end state of the repeated sharing in one pass over one row per source.
    ``percent`` must not ask for more than all sources can give.
    """
    if percent > 100 * most_repeats:
        raise ValueError("the sources cannot give that many words")
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_room = Window.orderBy("room_per_weight", "position")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_room.rowsBetween(0, Window.unboundedFollowing)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    turns = F.array(*[F.lit(w) for w in weights])
    sized = (
        documents.groupBy("source")
        .agg(F.sum(words_in(F.col("text"))).alias("source_size"))
        .withColumn("position", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.get(turns, F.col("position") % len(weights)).cast("bigint"))
        .withColumn("room", F.col("source_size") * most_repeats)
        .withColumn("room_per_weight", F.col("room").cast("double") / F.col("weight"))
    )
    # Everything is kept in hundredths of a word, as whole numbers, up to the last division.
    left = F.sum("source_size").over(every) * percent - 100 * F.coalesce(
        F.sum("room").over(before), F.lit(0)
    )
    shared = sized.withColumn("left", left).withColumn("rest", F.sum("weight").over(onwards))
    full = F.col("room_per_weight") * F.col("rest") * 100 <= F.col("left").cast("double")
    first_open = shared.withColumn("is_full", full).withColumn(
        "open_at",
        F.min(F.when(~F.col("is_full"), F.struct("room_per_weight", "position", "left", "rest"))).over(
            every
        ),
    )
    open_target = (
        (F.col("weight") * F.col("open_at.left")).cast("double")
        / (F.col("open_at.rest") * 100).cast("double")
    )
    return first_open.select(
        "source",
        "source_size",
        F.when(F.col("is_full"), F.col("room").cast("double")).otherwise(open_target).alias("target"),
    )


def plan(documents: DataFrame, targets: DataFrame, seed: str = SEED) -> DataFrame:
    """``documents`` with ``mix_size``, ``mix_source_size``, ``mix_target`` and ``mix_copies``.

    A null text has no words and is taken as often as others of its source; a source
    without words has the rate 0. Rows that repeat a document id share one decision; rows without an
    id are told apart by their texts. ``targets``
    should be a stored table: its known size then decides whether it is broadcast.
    """
    named = targets.select(
        F.col("source").alias("mix_source"),
        F.col("source_size").alias("mix_source_size"),
        F.col("target").alias("mix_target"),
    )
    rate = F.when(
        F.col("mix_source_size") > 0, F.col("mix_target") / F.col("mix_source_size")
    ).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    by_text = F.concat(F.lit(":"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    extra = uniform(seed, F.coalesce(F.col("doc_id").cast("string"), by_text)) < rate - whole
    return (
        documents.withColumn("mix_size", words_in(F.col("text")))
        .join(named, F.col("source").eqNullSafe(F.col("mix_source")))
        .withColumn("mix_copies", (whole + extra.cast("bigint")).cast("bigint"))
        .drop("mix_source")
    )


def mix(documents: DataFrame, seed: str = SEED) -> DataFrame:
    """The mixed corpus: rows of ``documents``, each as often as its repetitions say.

    Other columns are kept; names starting with ``mix_`` are for the operator.
    """
    planned = plan(documents, staged(source_targets(documents)), seed)
    repeated = planned.withColumn(
        "mix_copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int")))
    )
    return repeated.filter("mix_copies > 0").select(*[documents[c] for c in documents.columns])


def query(spark, folder: str) -> DataFrame:
    """Every document with its size, its source's size and target, and the words that the mix takes of it."""
    documents = table(spark, folder, "documents").select("doc_id", "source", "text")
    planned = plan(documents, staged(source_targets(documents)))
    return planned.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
    )


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(CAST(doc_id AS VARCHAR), ':' || sha256(coalesce(text, ''))) AS drawn_by, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
  FROM documents),
sources AS (
  SELECT source, sum(size) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS position
  FROM sized GROUP BY source),
weighted AS (
  SELECT *, [5, 2, 1][CAST(position % 3 AS INT) + 1] AS weight FROM sources),
ordered AS (
  SELECT *, CAST(2 * source_size AS DOUBLE) / weight AS r FROM weighted),
shared AS (
  SELECT *,
    sum(source_size) OVER () * 150 - 100 * coalesce(sum(2 * source_size) OVER (
      ORDER BY r, position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
    sum(weight) OVER (ORDER BY r, position ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM ordered),
flagged AS (SELECT *, r * rest * 100 <= CAST(remaining AS DOUBLE) AS is_full FROM shared),
opened AS (SELECT remaining, rest FROM flagged WHERE NOT is_full ORDER BY r, position LIMIT 1),
targets AS (
  SELECT source, source_size,
    CASE WHEN is_full THEN CAST(2 * source_size AS DOUBLE)
      ELSE CAST(weight * (SELECT remaining FROM opened) AS DOUBLE)
           / CAST((SELECT rest FROM opened) * 100 AS DOUBLE) END AS target
  FROM flagged),
rated AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
    CAST(CAST('0x' || substr(md5('mix:' || s.drawn_by), 1, 13) AS BIGINT) AS DOUBLE)
      / 4503599627370496.0 AS u
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
  CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rated
"""
