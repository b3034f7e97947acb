"""Token ids in Parquet files.

Texts are range-partitioned by document id, encoded, and written by Spark's Parquet writer in
ascending order: one row per document with ``doc_id``, ``n_tokens`` and the list ``ids``. Ids are
dictionary-encoded where that pays and delta-encoded where the dictionary gets too large (writer
version 2); row groups and pages have set sizes, and page indexes let a reader skip to single documents.
Reading only metadata touches two narrow columns.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clientbook.llm.common import slices, table
from clientbook.llm.segments import LATIN, is_word, part_starts
from clientbook.operators.staging import shared_folder

END = 0
#: Row groups and pages in bytes: a group fits a task, a page a few documents.
WRITE_OPTIONS = {
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.dictionary.page.size": str(512 << 10),
    "parquet.enable.dictionary": "true",
    "parquet.writer.version": "PARQUET_2_0",
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "1",
}


class Ids(dict):
    """Word or rest to its ids, encoded when first looked up; a lookup of a known one runs no Python.

    Two generations bound the memory: when the young one is full it replaces the old one. Parts over
    ``longest`` characters are not kept.
    """

    def __init__(self, encode: Callable[[str], bytes], most: int = 400_000, longest: int = 64):
        super().__init__()
        self.encode, self.most, self.longest, self.old = encode, most, longest, {}

    def __missing__(self, part: str) -> bytes:
        found = self.old.get(part)
        if found is None:
            found = self.encode(part)
            if len(part) > self.longest:
                return found
        if len(self) >= self.most:
            self.old = {}  # let go before the copy is made
            self.old = dict(self)
            self.clear()
        self[part] = found
        return found


_encoders: dict[tuple[str, bool], Ids] = {}


def _encoder(model: str, path: str, special: bool) -> Ids:
    """Word or rest to its ids as little-endian 32-bit integers; kept while the worker lives.

    A plain word is one match of the tokenizer's pattern, so its spelling in the byte alphabet goes
    to the tokenizer's model at once; everything else goes through the whole tokenizer.
    """
    key = path, special
    if key not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(model)
        tokenizer.encode_special_tokens = not special
        merges, spell, whole = tokenizer.model.tokenize, tokenizer.pre_tokenizer.pre_tokenize_str, tokenizer.encode_batch_fast
        space = spell(" ")[0][0]
        alphabet = {i: spell(chr(i))[0][0] for i in range(0x20, 0x250) if re.match(f"[ {LATIN}]", chr(i))}

        def encode(part: str) -> bytes:
            if not is_word(part):
                return array("I", whole([part], add_special_tokens=False)[0].ids).tobytes()
            # Of an ASCII word only the space is spelled otherwise.
            spelled = part.replace(" ", space) if part.isascii() else part.translate(alphabet)
            return array("I", [x.id for x in merges(spelled)]).tobytes()

        _encoders[key] = Ids(encode)
    return _encoders[key]


def ids_of(texts: pa.Array, ids: Callable[[str], bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Where each text's ids begin, and the end; and the ids of all texts, each with its end id. A null text is empty.

    Arrow numbers the distinct parts of all texts, ``ids`` is asked once for each, and Arrow puts the answers in place.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, letters = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(letters or b"", np.uint8)[at[0] : at[-1]]
    at = at - at[0]
    starts = part_starts(data, at)
    cut = pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts), pa.py_buffer(data)).dictionary_encode()
    found = list(map(ids, cut.dictionary.to_numpy(zero_copy_only=False)))
    values = pa.array(found, pa.large_binary()).take(cut.indices)
    place = np.zeros(len(starts), np.int64)
    np.cumsum(pc.binary_length(values).to_numpy(zero_copy_only=False) // 4, out=place[1:])
    ends = place[np.searchsorted(starts, at)]
    joined = np.insert(np.frombuffer(values.buffers()[2] or b"", "<u4", place[-1]), ends[1:], END)
    return ends + np.arange(len(ends)), joined


def tokenized(documents: DataFrame, model_path: str, special: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids) of every text, the end id included; a null text has the end id alone.

    With ``special`` a special token written out in a text gets its own id, as the library's
    ``encode`` does unless told otherwise; without, it is text like any other.
    """
    with open(model_path, encoding="utf-8") as file:  # of fixed size, whatever the data
        shared = documents.sparkSession.sparkContext.broadcast(file.read())

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _encoder(shared.value, model_path, special).__getitem__
        for batch in batches:
            for part in slices(batch, "text"):
                at, values = ids_of(part.column(1), ids)
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values.view(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(at)), lists], names=["doc_id", "n_tokens", "ids"])

    return documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        each, "doc_id bigint, n_tokens bigint, ids array<int>"
    )


def write_files(documents: DataFrame, path: str, model_path: str, special: bool = False) -> str:
    """Write the token files of (doc_id, text); rows without an id come first. Returns ``path``."""
    ordered = (
        documents.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    )
    tokenized(ordered, model_path, special).write.options(**WRITE_OPTIONS).parquet(path)
    return path


def read_ids(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids), of some documents only if asked: page indexes skip the rest."""
    stored = spark.read.parquet(path)
    return stored if doc_ids is None else stored.filter(F.col("doc_id").isin(doc_ids))


def with_starts(read: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """Adds ``start``, the number of ids of all documents before, from the columns of ``read``.

    ``read`` has doc_id, n_tokens, file and place (in the file); ``sizes`` has the first three as
    stored, so that the totals read two narrow columns and no ids. Sums are per file, then over
    the one-row-per-file totals, so no task sees all documents.
    """
    files = (read if sizes is None else sizes).groupBy("file").agg(F.min("doc_id").alias("least"), F.sum("n_tokens").alias("total"))
    order = Window.orderBy(F.col("least").asc_nulls_first(), "file")
    before = F.sum("total").over(order.rowsBetween(Window.unboundedPreceding, -1))
    offsets = files.select("file", F.coalesce(before, F.lit(0)).alias("offset"))
    inside = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return (
        read.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(offsets, "file")
        .withColumn("start", F.col("offset") + F.col("inside"))
        .drop("offset", "inside")
    )


def checksums(read: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, file, place, ids_crc32): crc32 over the ids as unsigned little-endian."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(4)
            at = np.asarray(ids.offsets)
            values = np.asarray(ids.values).view("<u4")
            sums = [zlib.crc32(values[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            counts = pa.array(np.diff(at).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), counts, batch.column(2), batch.column(3), pa.array(sums, pa.int64())],
                names=["doc_id", "n_tokens", "file", "place", "ids_crc32"],
            )

    return read.select("doc_id", "n_tokens", "file", "place", "ids").mapInArrow(
        each, "doc_id bigint, n_tokens bigint, file string, place bigint, ids_crc32 bigint"
    )


def query(spark, folder: str) -> DataFrame:
    """Places, lengths and checksums of the documents as read back from the token files."""
    import public_tokenizers

    path = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    write_files(table(spark, folder, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), special=True)
    stored = read_ids(spark, path).withColumns(
        {"file": F.col("_metadata.file_name"), "place": F.col("_metadata.row_index")}
    )
    return with_starts(checksums(stored), stored).select("doc_id", "start", "n_tokens", "ids_crc32")
