"""Near-duplicate embeddings by cross-polytope hashing.

A vector is rotated by three rounds of random signs and a fast Hadamard transform; its hash is the
nearest vertex of the cross-polytope, the coordinate of largest size with its sign. A table's
bucket joins HASHES such vertices. Every vector is stored in its own bucket of each table and looked
up in PROBES buckets: its own and those whose vertices are next nearest. Candidate pairs are verified
by their cosine in double precision.

Equal vectors are one class before anything is hashed. Large buckets are cut into blocks that are
compared block by block, so no task holds a bucket. Bucket rows carry the vector's number and a sketch of
128 signs; blocks are first compared by sketch, and only rows with a possible partner in their block
fetch their vectors. Pairs are not written out: each task counts, for
each vector, the links it is the first to find (tables and probes have an order, and the hashes of
both vectors tell whether an earlier one finds the pair), and gives the links' local components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientbook.llm.common import components, table
from clientbook.operators.staging import staged

TABLES = 8
HASHES = 2
PROBES = 7
LEAST_COSINE = 0.9
#: Vectors per block of a bucket that is compared at once.
BLOCK = 512
_PAIRS = 1 << 19
#: Of 128 random planes a pair at the threshold has 18 between its vectors on average; more than 44 with a
#: probability under 1e-8, unrelated vectors 44 or fewer with one of 3e-4.
_MOST_APART = 44


@lru_cache(maxsize=4)
def _planes(dims: int) -> np.ndarray:
    return np.random.default_rng([dims, 128]).normal(size=(dims, 128))


def sketches(units: np.ndarray) -> np.ndarray:
    """(vectors, 2) 64-bit words: on which side of each random plane a vector lies."""
    return np.packbits(units @ _planes(units.shape[1]) >= 0, axis=1).view(np.int64)


@lru_cache(maxsize=4)
def _signs(width: int) -> np.ndarray:
    draw = np.random.default_rng(width)
    return draw.choice([-1.0, 1.0], size=(TABLES * HASHES, 3, width))


def _hadamard(x: np.ndarray) -> np.ndarray:
    n, width = x.shape
    step = 1
    while step < width:
        x = x.reshape(n, width // (2 * step), 2, step)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2).reshape(n, width)
        step *= 2
    return x / np.sqrt(width)


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def buckets(units: np.ndarray) -> np.ndarray:
    """(vectors, TABLES, PROBES) bucket numbers, the first of each row being the vector's own."""
    n, dims = units.shape
    width = max(2, 1 << (dims - 1).bit_length())
    padded = np.zeros((n, width))
    padded[:, :dims] = units
    keep = min(4, width)
    vertex = np.empty((n, TABLES * HASHES, keep), dtype=np.int64)
    loss = np.empty((n, TABLES * HASHES, keep))
    for i, rounds in enumerate(_signs(width)):
        x = padded
        for signs in rounds:
            x = _hadamard(x * signs)
        size = np.abs(x)
        top = np.argsort(-size, axis=1, kind="stable")[:, :keep]
        best = np.take_along_axis(size, top, 1)
        vertex[:, i] = top * 2 + (np.take_along_axis(x, top, 1) < 0)
        loss[:, i] = best[:, :1] - best
    vertex = vertex.reshape(n, TABLES, HASHES, keep)
    loss = loss.reshape(n, TABLES, HASHES, keep)
    code, cost = vertex[:, :, 0], loss[:, :, 0]
    for h in range(1, HASHES):
        code = (code[..., :, None] * (2 * width) + vertex[:, :, h, None, :]).reshape(n, TABLES, -1)
        cost = (cost[..., :, None] + loss[:, :, h, None, :]).reshape(n, TABLES, -1)
    order = np.argsort(cost, axis=2, kind="stable")[:, :, :PROBES]
    return np.take_along_axis(code, order, 2) * TABLES + np.arange(TABLES)[None, :, None]


def usable(embedding: str) -> Column:
    """Not null, not zero, and without null or non-finite components."""
    column = F.col(embedding)
    fine = F.forall(
        column,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")),
    )
    return column.isNotNull() & fine & F.exists(column, lambda x: x != 0)


def _hashed(vectors: DataFrame) -> DataFrame:
    """(bucket, role, node, sketch_a, sketch_b): role 0 stored, 1 looked up; one row each per bucket."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 1024):
                part = batch.slice(start, 1024)
                rows = part.column(1)
                sizes = rows.value_lengths().to_numpy()
                for dims in np.unique(sizes):
                    chosen = part.take(pa.array(np.flatnonzero(sizes == dims)))
                    n = len(chosen)
                    units = unit(np.stack(chosen.column(1).to_numpy(zero_copy_only=False)).astype(float))
                    found = buckets(units) * 4096 + dims % 4096
                    own = found[:, :, 0]
                    codes = np.concatenate([own.ravel(), found.reshape(n, -1).ravel()])
                    role = np.repeat([0, 1], [own.size, found.size]).astype(np.int32)
                    back = np.concatenate([np.repeat(np.arange(n), TABLES), np.repeat(np.arange(n), found[0].size)])
                    node, sketch = chosen.column(0).to_numpy()[back], sketches(units)[back]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in (codes, role, node, sketch[:, 0].copy(), sketch[:, 1].copy())],
                        names=["bucket", "role", "node", "sketch_a", "sketch_b"],
                    )

    return vectors.select("node", "embedding").mapInArrow(
        each, "bucket bigint, role int, node bigint, sketch_a bigint, sketch_b bigint"
    )


def _possible(groups: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Of whole groups (rows of equal key): the rows whose sketch is near one of the other role in their group."""
    batch = pa.Table.from_batches(groups).combine_chunks().to_batches()[0]
    order = np.lexsort((batch["role"].to_numpy(), batch["key"].to_numpy()))
    key, role, node, one, two = (batch[c].to_numpy()[order] for c in ("key", "role", "node", "sketch_a", "sketch_b"))
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    stops = np.concatenate((starts[1:], [len(key)]))
    stored = np.add.reduceat(role == 0, starts)
    # Each stored row and where the looked-up rows of its group begin and how many they are.
    mine = np.flatnonzero(role == 0)
    begin = np.repeat(starts + stored, stored)
    count = np.repeat(stops - starts - stored, stored)
    alive = np.zeros(len(key), dtype=bool)
    share = np.cumsum(count) // _PAIRS
    cuts = [0, *(np.flatnonzero(np.diff(share)) + 1), len(mine)]
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        n = count[low:high]
        a = np.repeat(mine[low:high], n)
        b = np.repeat(begin[low:high] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        apart = np.bitwise_count(one[a] ^ one[b]) + np.bitwise_count(two[a] ^ two[b])
        near = (apart <= _MOST_APART) & (node[a] != node[b])
        alive[a[near]] = True
        alive[b[near]] = True
    return batch.take(pa.array(order[alive])).select(["key", "bucket", "role", "node"])


def _links(groups: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Of whole groups (rows of equal key): per node its newly found links and local component."""
    batch = pa.Table.from_batches(groups).combine_chunks()
    key, role = batch["key"].to_numpy(), batch["role"].to_numpy()
    node, weight = batch["node"].to_numpy(), batch["weight"].to_numpy()
    units = unit(np.stack(batch["embedding"].combine_chunks().to_numpy(zero_copy_only=False)).astype(float)) \
        if len(set(batch["embedding"].combine_chunks().value_lengths().to_pylist())) == 1 else None
    if units is None:  # a key holds vectors of one length; a batch may hold several keys
        parts = []
        lengths = batch["embedding"].combine_chunks().value_lengths().to_numpy()
        for size in np.unique(lengths):
            parts.append(_links(batch.filter(pa.array(lengths == size)).to_batches()))
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
    order = np.lexsort((role, key))
    key, role, node, weight, units = key[order], role[order], node[order], weight[order], units[order]
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    stops = np.concatenate((starts[1:], [len(key)]))
    stored = np.add.reduceat(role == 0, starts)
    links_a, links_b = [], []
    held = 0
    pending: list[tuple[np.ndarray, np.ndarray]] = []

    def settle():
        a = np.concatenate([p[0] for p in pending])
        b = np.concatenate([p[1] for p in pending])
        close = np.einsum("ij,ij->i", units[a], units[b]) >= LEAST_COSINE
        links_a.append(a[close])
        links_b.append(b[close])
        pending.clear()

    for start, stop, n in zip(starts, stops, stored, strict=True):
        looked = stop - start - n
        if not n or not looked:
            continue
        if n * looked > 4096:
            # The product rounds differently: what it leaves out must be clearly below the threshold.
            i, j = np.nonzero(units[start : start + n] @ units[start + n : stop].T >= LEAST_COSINE - 1e-9)
            a, b = start + i, start + n + j
        else:
            a = np.repeat(np.arange(start, start + n), looked)
            b = np.tile(np.arange(start + n, stop), n)
        other = node[a] != node[b]
        pending.append((a[other], b[other]))
        held += int(other.sum())
        if held > _PAIRS:
            settle()
            held = 0
    if pending:
        settle()
    a = np.concatenate(links_a) if links_a else np.empty(0, np.int64)
    b = np.concatenate(links_b) if links_b else np.empty(0, np.int64)
    return _counted(a, b, key, batch["bucket"].to_numpy()[order], node, weight, units)


def _counted(a, b, key, bucket, node, weight, units) -> pa.RecordBatch:
    involved, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    new = np.ones(len(a), dtype=bool)
    if len(a):
        found = buckets(units[involved])
        ia, ib = where[: len(a)], where[len(a) :]
        table_of = (bucket[a] // 4096) % TABLES
        for start in range(0, len(a), _PAIRS // 8):
            s = slice(start, start + _PAIRS // 8)
            one, two = found[ia[s]], found[ib[s]]
            forward = (one[:, :, :1] == two).any(axis=2)  # b looked up finds a stored
            backward = (two[:, :, :1] == one).any(axis=2)
            ahead = np.arange(TABLES)[None, :] < table_of[s, None]
            earlier = ((forward | backward) & ahead).any(axis=1)
            here = np.take_along_axis(backward, table_of[s, None], 1)[:, 0]
            # In one table both directions may find the pair: the smaller node stored counts.
            new[s] = ~earlier & (~here | (node[a[s]] < node[b[s]]))
    nodes, at = np.unique(np.concatenate([node[a], node[b]]), return_inverse=True)
    ia, ib = at[: len(a)], at[len(a) :]
    count = np.zeros(len(nodes), dtype=np.int64)
    np.add.at(count, ia[new], weight[b[new]])
    np.add.at(count, ib[new], weight[a[new]])
    label = np.arange(len(nodes))
    while len(a):
        before = label.copy()
        least = np.minimum(label[ia], label[ib])
        np.minimum.at(label, ia, least)
        np.minimum.at(label, ib, least)
        label = label[label]
        if (label == before).all():
            break
    return pa.RecordBatch.from_arrays(
        [pa.array(nodes, pa.int64()), pa.array(count), pa.array(nodes[label] if len(nodes) else nodes, pa.int64())],
        names=["node", "links", "label"],
    )


def _by_key(rows: DataFrame, work: Callable[[list[pa.RecordBatch]], pa.RecordBatch], kinds: str) -> DataFrame:
    """``work`` over whole groups of ``rows``, which are sorted by their first column, the key, in their partition."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for whole in batches:
            for start in range(0, len(whole), 4096):
                batch = whole.slice(start, 4096)
                key = batch.column(0).to_numpy()
                if size >= 8192 and (cut := np.flatnonzero(np.concatenate(([last], key[:-1])) != key)).size:
                    # Keys up to the last change are complete.
                    at = int(cut[-1])
                    yield work([*held, batch.slice(0, at)])
                    held, size = [], 0
                    batch = batch.slice(at)
                held.append(batch)
                size += len(batch)
                last = key[-1]
        if size:
            yield work(held)

    return rows.mapInArrow(each, kinds)


def near_duplicates(embeddings: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per row of (vec_id, embedding).

    Vectors that are null, zero or hold null or non-finite components link with nothing, and so do
    rows without an id; vectors link only with others of their length. Rows that repeat a vector
    count as separate vectors. Other columns are ignored.
    """
    # Single precision stays as it is on the way: cosines are worked out in double precision.
    kind = embeddings.schema["embedding"].dataType.simpleString()
    rows = embeddings.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("embedding").cast(kind if kind == "array<float>" else "array<double>").alias("embedding"),
    )
    rows = rows.withColumn("linkable", F.coalesce(usable("embedding"), F.lit(False)) & F.col("vec_id").isNotNull())
    rows = staged(rows)
    linkable = rows.filter("linkable")
    classes = staged(
        linkable.groupBy("embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"))
    )
    hashed = _hashed(classes)
    sizes = hashed.groupBy("bucket").agg(
        F.sum(F.expr("1 - role")).alias("stored"), F.sum("role").alias("looked")
    )
    # One bucket number in BLOCK rows at most can need cutting.
    large = sizes.filter(F.greatest("stored", "looked") > BLOCK).select(
        "bucket",
        F.ceil(F.col("stored") / BLOCK).cast("int").alias("stored_blocks"),
        F.ceil(F.col("looked") / BLOCK).cast("int").alias("looked_blocks"),
    )
    cut = hashed.join(large, "bucket", "left")
    stored_blocks = F.greatest(F.coalesce("stored_blocks", F.lit(1)), F.lit(1))
    looked_blocks = F.greatest(F.coalesce("looked_blocks", F.lit(1)), F.lit(1))
    mine = F.pmod(F.xxhash64("node"), F.when(F.col("role") == 0, stored_blocks).otherwise(looked_blocks))
    others = F.sequence(F.lit(0), F.when(F.col("role") == 0, looked_blocks).otherwise(stored_blocks) - 1)
    spread = cut.withColumn("mine", mine).withColumn("other", F.explode(others))
    first = F.when(F.col("role") == 0, F.col("mine")).otherwise(F.col("other").cast("bigint"))
    second = F.when(F.col("role") == 0, F.col("other").cast("bigint")).otherwise(F.col("mine"))
    keyed = spread.select(F.xxhash64("bucket", first, second).alias("key"), "bucket", "role", "node", "sketch_a", "sketch_b")
    possible = _by_key(
        keyed.repartition("key").sortWithinPartitions("key"),
        _possible,
        "key bigint, bucket bigint, role int, node bigint",
    )
    fetched = possible.join(classes, "node").select("key", "bucket", "role", "node", "weight", "embedding")
    found = staged(
        _by_key(
            fetched.repartition("key").sortWithinPartitions("key"), _links, "node bigint, links bigint, label bigint"
        )
    )
    reached = components(found.select(F.col("node").alias("a"), F.col("label").alias("b")), "a", "b")
    totals = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = (
        classes.join(totals, "node", "left")
        .join(reached.select("node", "component"), "node", "left")
        .select(
            F.col("embedding").alias("class_embedding"),
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    matched = F.col("linkable") & (F.col("embedding") == F.col("class_embedding"))
    return (
        rows.join(named, matched, "left")
        .withColumn("component_id", F.coalesce("component_id", "vec_id"))
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
            "component_id",
            F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
        )
    )


def query(spark, folder: str) -> DataFrame:
    """Every vector with its links, its component and whether it stays; awkward vectors link with nothing."""
    return near_duplicates(table(spark, folder, "embeddings"))


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  AND list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (
  WITH RECURSIVE t(x, y) AS (SELECT x, y FROM l UNION SELECT t.x, l.y FROM t JOIN l ON t.y = l.x)
  SELECT x, min(y) AS m FROM t GROUP BY x),
n AS (SELECT x, count(*) AS n FROM l GROUP BY x)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, least(e.vec_id, coalesce(r.m, e.vec_id)) AS component_id,
  e.vec_id = least(e.vec_id, coalesce(r.m, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN n ON n.x = e.vec_id LEFT JOIN r ON r.x = e.vec_id
"""
