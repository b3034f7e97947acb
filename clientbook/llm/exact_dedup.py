"""Exact duplicates by Patricia tries.

Texts are equal when they are the same bytes without the six ASCII space characters. Each task puts the
full byte strings of its rows into a compressed radix trie whose terminal nodes hold the owner so far
(the row with the longest original text, then the smallest id) and a count of rows. When a trie
holds more than MOST_HELD bytes it spills by subtree: the largest one below the root leaves as finished
rows. What is left of a large group of copies is thus a few rows per task, whatever its size.

Those rows go, once each with their bytes, to partitions by length and content hash (SHA-256), and
arrive there in that order. The same trie merges them; between two keys it may be emptied, as no
later row can equal one before. Bytes alone decide what is equal: two texts under one key would be two
terminals, which is reported as an error rather than merged. Every document then finds its owner by
length and hash in a join of narrow rows, which the adaptive planner splits where one text has most of
them; repeated rows of one id are counted before it.

Awkward rows: a null or blank text is the empty byte string, one group like any other. A null id is larger
than every id; ``keep_id`` is null where all of a group are. Of repeated rows (same id, same length) that
could stay one does. An empty table gives no rows; extra columns are left out. Texts may be as long as
an Arrow batch can hold; none is cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientbook.llm.common import slices, table

#: Bytes of text a task's trie holds before it spills.
MOST_HELD = 32 << 20
SPACES = b" \t\n\x0b\x0c\r"


class Owner(NamedTuple):
    """The row that stays of some equal texts, and how many there are."""

    chars: int
    doc_id: int | None
    rows: int

    def merged(self, other: Owner) -> Owner:
        mine, theirs = ((-o.chars, o.doc_id is None, o.doc_id or 0) for o in (self, other))
        best = self if mine <= theirs else other
        return Owner(best.chars, best.doc_id, self.rows + other.rows)


class Node:
    __slots__ = ("label", "owner", "children")

    def __init__(self, label: bytes, owner: Owner | None = None):
        self.label, self.owner, self.children = label, owner, {}


def _shared(label: bytes, text: bytes, at: int) -> int:
    """How many bytes of ``label`` stand in ``text`` from ``at`` on."""
    if text.startswith(label, at):
        return len(label)
    low, high = 0, min(len(label), len(text) - at)
    while low < high:  # halving keeps the comparing of long labels in compiled code
        middle = (low + high + 1) // 2
        if text.startswith(label[:middle], at):
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """A Patricia trie: every node but the root and the terminals has at least two children."""

    def __init__(self):
        self.root, self.held = Node(b""), 0

    def insert(self, text: bytes, owner: Owner) -> None:
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                node.children[text[at]] = Node(text[at:], owner)
                self.held += len(text) - at
                return
            same = _shared(child.label, text, at)
            if same < len(child.label):
                fork = Node(child.label[:same])
                child.label = child.label[same:]
                fork.children[child.label[0]] = child
                node.children[text[at]] = child = fork
            node, at = child, at + same
        node.owner = owner if node.owner is None else node.owner.merged(owner)

    def _under(self, node: Node, before: bytes) -> Iterator[tuple[bytes, Owner]]:
        stack = [(node, before)]
        while stack:
            here, text = stack.pop()
            text += here.label
            if here.owner is not None:
                yield text, here.owner
            stack.extend((child, text) for child in here.children.values())

    def everything(self) -> Iterator[tuple[bytes, Owner]]:
        """All terminals; the trie is empty afterwards."""
        root, self.root, self.held = self.root, Node(b""), 0
        yield from self._under(root, b"")

    def spill(self) -> Iterator[tuple[bytes, Owner]]:
        """The terminals of the subtree of the root that holds most; it leaves the trie."""
        sizes = {}
        for first, child in self.root.children.items():
            sizes[first], stack = 0, [child]
            while stack:
                node = stack.pop()
                sizes[first] += len(node.label)
                stack.extend(node.children.values())
        largest = max(sizes, key=sizes.get)
        self.held -= sizes[largest]
        yield from self._under(self.root.children.pop(largest), b"")


def _keyed(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[bytes], list[int]]]:
    """Parts of a batch of (doc_id, text) with each row's bytes without spaces and its code points."""
    for part in slices(batch, "text"):
        texts = pc.fill_null(part.column(1), "")
        chars = pc.utf8_length(texts).to_pylist()
        yield part, [text.as_buffer().to_pybytes().translate(None, SPACES) for text in texts], chars


_OWNED = pa.schema(
    [
        ("n_bytes", pa.int64()), ("digest", pa.binary()), ("body", pa.binary()),
        ("chars", pa.int64()), ("doc_id", pa.int64()), ("rows", pa.int64()),
    ]
)


def _owned(found: Iterator[tuple[bytes, Owner]]) -> Iterator[pa.RecordBatch]:
    rows, held = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _OWNED, strict=True)], schema=_OWNED
        )

    for body, owner in found:
        rows.append((len(body), hashlib.sha256(body).digest(), body, *owner))
        held += len(body)
        if held > 4 << 20 or len(rows) == 4096:
            yield batch()
            rows, held = [], 0
    if rows:
        yield batch()


def _local_owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per distinct text of a task, or a few where the trie had to spill."""
    trie = Trie()
    for batch in batches:
        for part, bodies, chars in _keyed(batch):
            for body, n, doc_id in zip(bodies, chars, part.column(0).to_pylist(), strict=True):
                trie.insert(body, Owner(n, doc_id, 1))
            while trie.held > MOST_HELD:
                yield from _owned(trie.spill())
    yield from _owned(trie.everything())


def _merged_owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of length and hash to one row per text."""
    trie, key, keys, texts = Trie(), None, 0, 0

    def done() -> Iterator[pa.RecordBatch]:
        nonlocal keys, texts
        for batch in _owned(trie.everything()):
            texts += len(batch)
            yield batch.drop_columns(["body"])
        if keys != texts:
            raise ValueError(f"{texts} texts have {keys} pairs of length and SHA-256")
        keys = texts = 0

    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if row[:2] != key:
                if trie.held > MOST_HELD:
                    yield from done()
                key, keys = row[:2], keys + 1
            trie.insert(row[2], Owner(*row[3:]))
    yield from done()


def owners(documents: DataFrame) -> DataFrame:
    """(n_bytes, digest, chars, doc_id, rows): the owner of each distinct text, and how many rows have it."""
    local = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        _local_owners, "n_bytes bigint, digest binary, body binary, chars bigint, doc_id bigint, rows bigint"
    )
    return (
        local.repartition("n_bytes", "digest")
        .sortWithinPartitions("n_bytes", "digest")
        .mapInArrow(_merged_owners, "n_bytes bigint, digest binary, chars bigint, doc_id bigint, rows bigint")
    )


def members(documents: DataFrame) -> DataFrame:
    """(doc_id, chars, n_bytes, digest, rows): documents without their texts, repeated rows counted."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, bodies, chars in _keyed(batch):
                digests = pa.array([hashlib.sha256(body).digest() for body in bodies], pa.binary())
                sizes = np.fromiter(map(len, bodies), np.int64, len(bodies))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(chars, pa.int64()), pa.array(sizes), digests],
                    names=["doc_id", "chars", "n_bytes", "digest"],
                )

    narrow = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        each, "doc_id bigint, chars bigint, n_bytes bigint, digest binary"
    )
    return narrow.groupBy("doc_id", "chars", "n_bytes", "digest").agg(F.count(F.lit(1)).alias("rows"))


def exact_duplicates(documents: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row of ``documents`` (doc_id, text)."""
    mine, theirs = members(documents).alias("mine"), owners(documents).alias("theirs")
    same = (F.col("mine.n_bytes") == F.col("theirs.n_bytes")) & (F.col("mine.digest") == F.col("theirs.digest"))
    stays = F.col("mine.doc_id").eqNullSafe(F.col("theirs.doc_id")) & (F.col("mine.chars") == F.col("theirs.chars"))
    return mine.join(theirs, same).select(
        F.col("mine.doc_id").alias("doc_id"),
        F.col("theirs.doc_id").alias("keep_id"),
        F.col("theirs.rows").alias("group_size"),
        # One of the repeated rows of an id stays.
        F.explode(
            F.transform(F.sequence(F.lit(1).cast("bigint"), F.col("mine.rows")), lambda nth: stays & (nth == 1))
        ).alias("kept"),
        F.lower(F.hex(F.col("mine.digest"))).alias("text_sha256"),
    )


def query(spark, folder: str) -> DataFrame:
    """Every document with the document that stays of its group."""
    return exact_duplicates(table(spark, folder, "documents"))


SQL = r"""
WITH plain AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents
)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
  row_number() OVER best = 1 AS kept, sha256(body) AS text_sha256
FROM plain WINDOW best AS (PARTITION BY body ORDER BY chars DESC, doc_id NULLS LAST)
"""
