"""What the two classifiers share: the training sample, a calibration, and scoring in batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientbook.llm.common import is_held_out, slices, uniform

#: Bound of the training sample: documents per class. Of each the whole text is learned from.
MOST_PER_CLASS = 3000


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def calibrated(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Scale and shift of a logistic curve, both classes weighing the same."""
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    scale = 1 / x.std() if x.std() > 1e-6 else 0.0
    a, b = 2.0, 0.0
    z = (x - x.mean()) * scale
    for _ in range(2000):
        error = weight * (sigmoid(a * z + b) - y)
        a, b = a - 2.0 * ((error * z).sum() + 2e-4 * a), b - 2.0 * error.sum()
    return float(a * scale), float(b - a * scale * x.mean())


def training_sample(
    documents: DataFrame, labels: DataFrame, label: str, features: Callable[[str], bytes] | None = None
) -> tuple[list, list]:
    """At most MOST_PER_CLASS documents per class, drawn by a hash of the id among rows not held out.

    Distinct texts only, so a large group of copies counts once. With ``features`` the driver
    receives what it makes of each whole text, worked out in tasks, in place of the text. Ids
    with contradicting labels count by the larger one; null labels are ignored.
    """
    known = (
        labels.filter(F.col(label).isin(0, 1) & ~is_held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(label).alias("label"))
        .join(documents.select("doc_id"), "doc_id", "left_semi")
        .withColumn("draw", uniform("sample", F.col("doc_id")))
    )
    # Ids are drawn before any text is read; the smallest draws of each task are all that moves.
    drawn = [
        known.filter(F.col("label") == value).orderBy("draw", "doc_id").limit(MOST_PER_CLASS)
        for value in (0, 1)
    ]
    rows = (
        documents.select("doc_id", "text")
        .filter(F.col("text").isNotNull())
        .join(F.broadcast(drawn[0].union(drawn[1])), "doc_id")
        .select("label", "draw", "doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("digest"), "text")
    )
    if features:
        rows = _with_features(rows, features)
    found = {}
    for row in sorted(rows.collect(), key=lambda r: (r.label, r.draw, r.doc_id, r.digest)):
        found.setdefault((row.label, row.digest), row[-1])
    return [bytes(x) if features else x for x in found.values()], [int(value) for value, _ in found]


def _with_features(rows: DataFrame, features: Callable[[str], bytes]) -> DataFrame:
    """``rows`` with the last column, the text, replaced by its features."""
    schema = rows.drop("text").withColumn("features", F.lit(b"")).schema

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                made = pa.array([features(text.as_py()) for text in part.column(4)], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns[:4], made], names=schema.names)

    return rows.mapInArrow(each, schema)


def scored_texts(
    documents: DataFrame, model, scorer: Callable[[object], Callable[[pa.Array], list]], name: str
) -> DataFrame:
    """``documents`` with the column ``name``: what ``scorer(model)`` makes of each batch of texts."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    schema = documents.select("*", F.lit(0.0).alias(name)).schema
    names = [*documents.columns, name]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(shared.value)
        for batch in batches:
            for part in slices(batch, "text"):
                scores = pa.array(score(part.column(part.schema.get_field_index("text"))), pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, scores], names=names)

    return documents.mapInArrow(each, schema)
