"""Byte-level BPE encoding and decoding.

Each Python worker folds the ranked merges over the bytes of the distinct words of its texts (a bounded memo
holds them from task to task), all new ones of a batch together, with the rank table as a literal map of about 50,000
entries; ids of a text are looked up word by word. Decoding concatenates the binary pieces of the ids.

Null and empty texts have no ids. Repeated rows give repeated results. Texts are taken whole, and a run of
letters without a space takes n log n steps, however long.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientbook.llm.common import slices, table
from clientbook.llm.segments import Memo, is_word, parts

#: Bytes of text that are cut and folded at a time; what that takes stays with the worker.
_SLICE = 1 << 20


def load_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Token bytes to rank from a file with a base64 token and its rank on each line.

    The file is a tokenizer's vocabulary, whose size its authors fixed; it does not grow
    with the data. It is read where the driver runs.
    """
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def fold(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one match: merge the adjacent pair of lowest rank, leftmost first, until none is known.

    A heap gives the next pair and links lead to its neighbours, so a run of n bytes takes n log n steps.
    """
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    part = [piece[i : i + 1] for i in range(n)]
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(rank, i) for i in range(n - 1) if (rank := ranks.get(piece[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        rank, i = heappop(heap)
        j = after[i]
        # Pairs that have changed since they were put in are left over; their new ranks are in as well.
        if part[i] is None or j >= n or ranks.get(part[i] + part[j]) != rank:
            continue
        part[i], part[j] = part[i] + part[j], None
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (rank := ranks.get(part[i] + part[k])) is not None:
                heappush(heap, (rank, i))
        if (h := before[i]) >= 0 and (rank := ranks.get(part[h] + part[i])) is not None:
            heappush(heap, (rank, h))
    return [ranks[p] for p in part if p is not None]


class Folder:
    """:func:`fold` for many words at once.

    Words of one length are rows of a matrix of ids. Each round merges the best pair of every row and looks
    up the two pairs next to it; rows without a known pair are done.
    """

    NONE = np.iinfo(np.int32).max
    #: Fewer words than this of one length, and longer words, are folded one by one.
    LEAST, LONGEST = 24, 64

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        keys = np.fromiter(pairs, np.int64, len(pairs))
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.merged = np.append(np.fromiter(pairs.values(), np.int32, len(pairs))[order], self.NONE)
        self.single = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.merged[at], self.NONE)

    def fold(self, words: list[bytes]) -> list[tuple[int, ...]]:
        found: list = [None] * len(words)
        lengths: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            rank = self.ranks.get(word)
            if rank is not None:
                found[i] = (rank,)
            else:
                lengths.setdefault(len(word), []).append(i)
        for length, rows in lengths.items():
            if length > self.LONGEST or len(rows) < self.LEAST:
                for i in rows:
                    found[i] = tuple(fold(words[i], self.ranks))
            else:
                self._fold_rows(words, rows, length, found)
        return found

    def _fold_rows(self, words: list[bytes], rows: list[int], length: int, found: list) -> None:
        letters = np.frombuffer(b"".join([words[i] for i in rows]), np.uint8).reshape(len(rows), length)
        ids, row = self.single[letters], np.array(rows)
        best = self._pairs(ids[:, :-1], ids[:, 1:])
        while len(row):
            at = best.argmin(axis=1)
            every = np.arange(len(row))
            rank = best[every, at]
            done = rank == self.NONE
            if done.any():
                for i, ready in zip(row[done].tolist(), ids[done].tolist(), strict=True):
                    found[i] = tuple(ready)
                open_ = ~done
                ids, best, row, at, rank = ids[open_], best[open_], row[open_], at[open_], rank[open_]
                every = np.arange(len(row))
            n, width = ids.shape
            ids[every, at] = rank
            keep = np.ones((n, width), bool)
            keep[every, at + 1] = False
            ids = ids[keep].reshape(n, width - 1)
            keep = np.ones((n, width - 1), bool)
            keep[every, at] = False
            best = best[keep].reshape(n, width - 2)
            if width == 2:
                for i, ready in zip(row.tolist(), ids.tolist(), strict=True):
                    found[i] = tuple(ready)
                return
            left, right = np.flatnonzero(at > 0), np.flatnonzero(at < width - 2)
            best[left, at[left] - 1] = self._pairs(ids[left, at[left] - 1], ids[left, at[left]])
            best[right, at[right]] = self._pairs(ids[right, at[right]], ids[right, at[right] + 1])


class Codec:
    """Encoder and decoder over one rank table and pattern.

    The memo has the ids of a part as bytes, which take a third of a tuple's memory, and lives as long as the worker.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, most: int = 300_000):
        self.match = regex.compile(pattern)
        self.pieces = {rank: token for token, rank in ranks.items()}
        self.spelled = {rank: str(rank) for rank in self.pieces}
        self.folder = Folder(ranks)
        self.known = Memo(self._parts, most)

    def _parts(self, new: list[str]) -> dict[str, bytes]:
        """Ids of distinct words and rests as 32-bit integers: all their matches are folded together."""
        cut = [[part] if is_word(part) else self.match.findall(part) for part in new]
        folded = iter(self.folder.fold([match.encode("utf-8") for matches in cut for match in matches]))
        return {part: array("i", chain.from_iterable(islice(folded, len(matches)))).tobytes() for part, matches in zip(new, cut, strict=True)}

    def encode_all(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of each text; what is not known yet of all of them is folded in one go."""
        found = self.known.of([parts(text or "") for text in texts])
        return [np.frombuffer(b"".join(values), np.int32).tolist() for values in found]

    def encode(self, text: str | None) -> list[int]:
        return self.encode_all([text])[0]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


_codecs: dict = {}


def _codec(shared, name: str, pattern: str) -> Codec:
    """The codec of a rank table (``name`` is its digest), kept with its memo while the worker lives."""
    key = (name, pattern)
    if key not in _codecs:
        _codecs.clear()  # one memo per worker bounds its memory
        _codecs[key] = Codec(shared.value, pattern)
    return _codecs[key]


def encoded(documents: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """``documents`` with ``bpe_ids``, an array of int; a null text has none.

    Other columns are kept; the name ``bpe_ids`` is for the operator.
    """
    schema = documents.withColumn("bpe_ids", F.array().cast("array<int>")).schema
    names, (shared, name) = [*documents.columns, "bpe_ids"], _shared(documents.sparkSession, ranks)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared, name, pattern)
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                texts = part.column(part.schema.get_field_index("text"))
                ids = pa.array(codec.encode_all(texts.to_pylist()), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, ids], names=names)

    return documents.mapInArrow(each, schema)


def decoded(encoded_documents: DataFrame, ranks: dict[bytes, int], ids: str = "bpe_ids") -> DataFrame:
    """The frame with ``bpe_bytes``, the concatenated pieces of each row's ids."""
    names, (shared, _) = [*encoded_documents.columns, "bpe_bytes"], _shared(encoded_documents.sparkSession, ranks)
    schema = encoded_documents.withColumn("bpe_bytes", F.lit(None).cast("binary")).schema

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = {rank: token for token, rank in shared.value.items()}
        for batch in batches:
            found = []
            for row in batch.column(batch.schema.get_field_index(ids)):
                found.append(b"".join(map(pieces.__getitem__, row.values.to_pylist())) if row.is_valid else None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], names=names)

    return encoded_documents.mapInArrow(each, schema)


_broadcasts: dict = {}


def _shared(spark: SparkSession, ranks: dict[bytes, int]):
    """One broadcast per application and table, and the table's digest."""
    name = hashlib.sha256(repr(list(ranks.items())).encode()).hexdigest()
    key = (spark.sparkContext.applicationId, name)
    if key not in _broadcasts:
        _broadcasts[key] = spark.sparkContext.broadcast(ranks)
    return _broadcasts[key], name


def digests(documents: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each whole text, by both directions."""
    shared, name = _shared(documents.sparkSession, ranks)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared, name, pattern)
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                counts, ids_hash, bytes_hash = [], [], []
                for ids in codec.encode_all(part.column(1).to_pylist()):
                    counts.append(len(ids))
                    ids_hash.append(hashlib.sha256(",".join(map(codec.spelled.__getitem__, ids)).encode()).hexdigest())
                    bytes_hash.append(hashlib.sha256(codec.decode(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts, pa.int64()), pa.array(ids_hash), pa.array(bytes_hash)],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return documents.select("doc_id", F.col("text").cast("string")).mapInArrow(
        each, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )


_tables: dict[str, dict[bytes, int]] = {}


def default_table(spark: SparkSession) -> tuple[dict[bytes, int], str]:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    if path not in _tables:
        _tables[path] = load_ranks(spark, path)
    return _tables[path], public_tokenizers.PATTERN


def query(spark, folder: str) -> DataFrame:
    """Digests of each document's token ids and of the bytes they decode to; a null text is empty."""
    documents = table(spark, folder, "documents").select(F.col("doc_id").cast("bigint"), "text")
    return digests(documents, *default_table(spark))
