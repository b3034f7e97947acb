"""Near duplicates by MinHash with tensored banding.

Plain banding with K hashes per key and L tables needs K*L minhashes. Here two collections of
``HALVES`` half keys, each of K/2 minhashes, are combined pairwise: every pair of a left and a
right half is the key of one table. 18**2 = 324 tables of K = 6 hashes then take 2*18*3 = 108
minhashes instead of 1944. Two sets of similarity 0.75 miss each other with probability
2*(1 - 0.75**3)**18 = 1e-4; at 0.8 it is 5e-6, and copies mostly have several neighbours.

1. One pass over the texts gives per document the size and a 128-bit hash of its shingle set,
   the half keys and an odd sketch. Equal sets are one class with its smallest id.
2. Keys of the class representatives are shuffled. Each bucket links its members to its
   smallest one, never all pairs; each member then tries its most frequent such neighbour.
3. Buckets whose members are still in different components give the pairs across components,
   first again by the smallest member per component, then all that remain. Pairs that
   sizes or odd sketches prove to be too different are left out: two sets differ at least by as many
   shingles as bits of their odd sketches differ, so this loses no link.
4. Every link is confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientbook.llm.common import components, slices, table
from clientbook.operators.staging import staged

WORDS = 5
#: Links need ``100 * intersection >= PERCENT * union``.
PERCENT = 75
HALVES = 18
HASHES_PER_HALF = 3
SKETCH_BITS = 1024
#: Up to so many ids of documents to re-read are broadcast, with as many numbers of deals; beyond, they are joined.
MOST_BROADCAST_IDS = 500_000

#: Bytes of text hashed at a time; a longer text counts as one part. Hashing takes some 50 times that in arrays.
_CHUNK = 1 << 20
_SPACES = (32, 9, 10, 11, 12, 13)


def _constants():
    draw = np.random.default_rng(20240901)
    odd = lambda n: draw.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    letters, base, steps, hashes = odd(256), odd(1)[0], odd(WORDS + 1), odd(2 * HALVES * HASHES_PER_HALF)
    for upper in range(65, 91):
        letters[upper] = letters[upper + 32]
    space = np.zeros(256, dtype=bool)
    space[list(_SPACES)] = True
    return letters, base, steps, hashes, space


_LETTERS, _BASE, _STEPS, _HASHES, _IS_SPACE = _constants()
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in ``data``, and the position of each; no word crosses a ``start``."""
    if not len(data):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    inside = ~_IS_SPACE[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[starts] = True
    cut[-1] = True
    before = np.concatenate(([False], inside[:-1]))
    first = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.concatenate((inside[1:], [False]))
    last = np.flatnonzero(inside & (~after | cut[1:]))
    sums = np.cumsum(_LETTERS[data] * _powers(_BASE, len(data)), dtype=np.uint64)
    before_first = np.where(first > 0, sums[first - 1], np.uint64(0))
    back = _powers(_INVERSE, len(data))[first]
    return _mixed((sums[last] - before_first) * back + (last - first).astype(np.uint64)), first


def _words_of_long(data: np.ndarray) -> np.ndarray:
    """Word hashes of one long text, piece by piece; pieces end at spaces."""
    found, at = [], 0
    while at < len(data):
        end = min(at + _CHUNK, len(data))
        while end < len(data):
            spaces = np.flatnonzero(_IS_SPACE[data[at:end]])
            if len(spaces) and spaces[-1]:
                end = at + int(spaces[-1])
                break
            end = min(end + _CHUNK, len(data))  # a word longer than a piece
        found.append(_word_hashes(data[at:end], np.zeros(1, np.int64))[0])
        at = end
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; empty for null or wordless texts."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    if len(data) > 2 * _CHUNK:
        words = [_words_of_long(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    else:
        every, at = _word_hashes(data, offsets[:-1][offsets[:-1] < len(data)])
        bounds = np.searchsorted(at, offsets)
        words = [every[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    valid = texts.is_valid().to_numpy(zero_copy_only=False)
    return [_shingles(w) if ok else np.empty(0, np.uint64) for w, ok in zip(words, valid, strict=True)]


def _shingles(words: np.ndarray) -> np.ndarray:
    if not len(words):
        return words
    wide = min(WORDS, len(words))
    count = len(words) - wide + 1
    total = np.full(count, wide, dtype=np.uint64) * _STEPS[WORDS]
    for i in range(wide):
        total += words[i : i + count] * _STEPS[i]
    return np.unique(_mixed(total))


def _set_key(shingles: np.ndarray) -> bytes:
    """128 bits of a set: two sums of independently mixed members, and its size."""
    if not len(shingles):
        return b""
    one = np.add.reduce(_mixed(shingles * _STEPS[0]))
    two = np.add.reduce(_mixed(shingles * _STEPS[1] + np.uint64(len(shingles))))
    return one.tobytes() + two.tobytes()


def _half_keys(sets: list[np.ndarray]) -> np.ndarray:
    """(documents, 2 * HALVES) half keys: hashes of HASHES_PER_HALF minima each."""
    sizes = np.array([len(s) for s in sets])
    filled = np.flatnonzero(sizes)
    out = np.zeros((len(sets), 2 * HALVES), dtype=np.uint64)
    if not len(filled):
        return out
    every = np.concatenate([sets[i] for i in filled])
    starts = np.concatenate(([0], np.cumsum(sizes[filled])[:-1]))
    scaled = np.empty_like(every)
    for half in range(2 * HALVES):
        key = np.full(len(filled), half, dtype=np.uint64) * _STEPS[2]
        for i in range(HASHES_PER_HALF):
            factor = _HASHES[half * HASHES_PER_HALF + i]
            np.multiply(every, factor, out=scaled)
            np.bitwise_xor(scaled, scaled >> np.uint64(32), out=scaled)
            key = _mixed(key + np.minimum.reduceat(scaled, starts) * _STEPS[i])
        out[filled, half] = key
    return out


def _odd_sketch(shingles: np.ndarray) -> np.ndarray:
    cells = np.bincount((shingles % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS)
    return np.packbits((cells & 1).astype(np.uint8)).view(np.int64)


def sketches(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_key, left_halves, right_halves, odd) of every text."""
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_shingles", pa.int64()),
            ("set_key", pa.binary()),
            ("left_halves", pa.list_(pa.int64())),
            ("right_halves", pa.list_(pa.int64())),
            ("odd", pa.list_(pa.int64())),
        ]
    )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _CHUNK):
                sets = shingle_sets(part.column(1))
                halves = _half_keys(sets).view(np.int64)
                left = pa.array(halves[:, :HALVES].ravel())
                right = pa.array(halves[:, HALVES:].ravel())
                at = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * HALVES)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_set_key(s) for s in sets], pa.binary()),
                        pa.ListArray.from_arrays(at, left),
                        pa.ListArray.from_arrays(at, right),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(len(sets) + 1, dtype=np.int32) * (SKETCH_BITS // 64)),
                            pa.array(np.concatenate([_odd_sketch(s) for s in sets])),
                        ),
                    ],
                    schema=schema,
                )

    return documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        each,
        "doc_id bigint, n_shingles bigint, set_key binary, left_halves array<bigint>,"
        " right_halves array<bigint>, odd array<bigint>",
    )


def _close_sizes(one: str, other: str) -> Column:
    smaller, larger = F.least(one, other), F.greatest(one, other)
    return smaller * 100 >= larger * PERCENT


def bucket_rows(representatives: DataFrame) -> DataFrame:
    """(bucket, doc_id, n_shingles) of all tables, of buckets with more than one member."""
    keys = F.flatten(
        F.transform("left_halves", lambda a: F.transform("right_halves", lambda b: F.xxhash64(a, b)))
    )
    rows = representatives.select("doc_id", "n_shingles", F.explode(keys).alias("bucket"))
    # Neighbours in the order of a bucket show whether it has a second member; no count is needed.
    ordered = Window.partitionBy("bucket").orderBy("n_shingles", "doc_id")
    return (
        rows.withColumn("head", F.first("doc_id").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("head_size", F.first("n_shingles").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("following", F.lead("doc_id").over(ordered))
        .filter("head <> doc_id OR following IS NOT NULL")
        .drop("following")
    )


def _dealt(pairs: DataFrame, side: str, other: str, among: int) -> DataFrame:
    """(doc_id, <side>_deals): which of ``among`` deals, told by the other document, the pairs of each document fall into.

    A document in many pairs, like the smallest of a large group of copies, is thus met by many tasks; its
    set is copied once per deal that occurs, so never more often than it has pairs.
    """
    return pairs.groupBy(F.col(side).alias("doc_id")).agg(F.collect_set(_deal(other, among)).alias(f"{side}_deals"))


def _deal(other: str, among: int) -> Column:
    return F.pmod(F.xxhash64(other), F.lit(among)).cast("int")


def confirmed(documents: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose full shingle sets are similar enough.

    The texts of the documents named are read again; each set is shuffled to the pairs of its
    document, as a list of hashes, and to nowhere else. The pairs of one document are dealt to as many
    tasks as a shuffle has. Of several texts with one id the set that sorts first counts.
    """
    pairs = staged(pairs)
    among = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = staged(_dealt(pairs, "a", "b", among).join(_dealt(pairs, "b", "a", among), "doc_id", "full"))
    # Neither ids nor deals can be more than two per pair.
    few = 2 * pairs.count() <= MOST_BROADCAST_IDS
    needed = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string")).join(
        F.broadcast(ids) if few else ids, "doc_id"
    )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _CHUNK):
                sets = pa.array([s.tobytes() for s in shingle_sets(part.column(1))], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), sets, part.column(2), part.column(3)], names=["doc_id", "shingles", "a_deals", "b_deals"]
                )

    sets = staged(
        needed.select("doc_id", "text", "a_deals", "b_deals").mapInArrow(
            each, "doc_id bigint, shingles binary, a_deals array<int>, b_deals array<int>"
        )
    )

    def with_set(rows: DataFrame, side: str, other: str, name: str) -> DataFrame:
        mine = sets.select(F.col("doc_id").alias(side), F.explode(f"{side}_deals").alias("deal"), "shingles")
        mine = mine.groupBy(side, "deal").agg(F.min("shingles").alias(name))
        return rows.withColumn("deal", _deal(other, among)).join(mine, [side, "deal"]).drop("deal")

    both = with_set(with_set(pairs, "b", "a", "right_set"), "a", "b", "left_set")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            keep = np.zeros(len(batch), dtype=bool)
            for i in range(len(batch)):
                one = np.frombuffer(left[i].as_buffer(), np.uint64)
                two = np.frombuffer(right[i].as_buffer(), np.uint64)
                shared = len(np.intersect1d(one, two, assume_unique=True))
                keep[i] = 100 * shared >= PERCENT * (len(one) + len(two) - shared)
            yield batch.select([0, 1]).filter(pa.array(keep))

    return staged(both.select("a", "b", "left_set", "right_set").mapInArrow(compare, "a bigint, b bigint"))


def _possible() -> Column:
    """Neither the sizes na, nb nor the odd sketches oa, ob rule the pair out."""
    differ = F.lit(0)
    for word in range(SKETCH_BITS // 64):
        differ = differ + F.bit_count(F.get("oa", F.lit(word)).bitwiseXOR(F.get("ob", F.lit(word))))
    # similarity >= p  <=>  symmetric difference <= (na + nb) * (1 - p) / (1 + p)
    close = differ * (100 + PERCENT) <= (F.col("na") + F.col("nb")) * (100 - PERCENT)
    return _close_sizes("na", "nb") & close


def _sides(facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    return tuple(
        facts.select(
            *[F.col(c) for c in facts.columns if c not in ("doc_id", "n_shingles", "odd", "component")],
            F.col("doc_id").alias(side),
            F.col("n_shingles").alias(f"n{side}"),
            F.col("odd").alias(f"o{side}"),
            *[F.col(c).alias(f"c{side}") for c in facts.columns if c == "component"],
        )
        for side in ("a", "b")
    )


def _may_link(pairs: DataFrame, facts: DataFrame) -> DataFrame:
    a, b = _sides(facts)
    return pairs.join(a, "a").join(b, "b").filter(_possible()).select("a", "b")


def _labelled(rows: DataFrame, links: list[DataFrame]) -> DataFrame:
    nodes = components(reduce(DataFrame.union, links), "a", "b")
    named = nodes.withColumnRenamed("node", "doc_id")
    return rows.join(named, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))


def links(documents: DataFrame, representatives: DataFrame) -> DataFrame:
    """(a, b): confirmed links that connect the same classes as all links would."""
    rows = staged(bucket_rows(representatives))
    facts = representatives.select("doc_id", "n_shingles", "odd")

    # To the head of a bucket: for each member the head it meets most often.
    to_head = (
        rows.filter("head <> doc_id")
        .filter(_close_sizes("n_shingles", "head_size"))
        .groupBy("doc_id", "head")
        .agg(F.count("*").alias("times"))
        .groupBy("doc_id")
        .agg(F.max(F.struct("times", "head")).alias("best"))
        .select(F.col("best.head").alias("a"), F.col("doc_id").alias("b"))
    )
    found = [confirmed(documents, _may_link(to_head, facts))]

    # Between components that share a bucket, by the smallest member of each.
    def open_rows() -> DataFrame:
        marked = staged(_labelled(rows.select("bucket", "doc_id", "n_shingles"), found))
        open_buckets = marked.groupBy("bucket").agg(
            F.min("component").alias("least"), F.max("component").alias("most")
        ).filter("least <> most").select("bucket", "least")
        return marked.join(open_buckets, "bucket")

    still = staged(open_rows())
    first = still.groupBy("bucket", "component").agg(F.min("doc_id").alias("doc_id"), F.first("least").alias("least"))
    heads = first.filter("component = least").select("bucket", F.col("doc_id").alias("head"))
    across = (
        first.filter("component <> least").join(heads, "bucket")
        .select(F.least("head", "doc_id").alias("a"), F.greatest("head", "doc_id").alias("b")).distinct()
    )
    found.append(confirmed(documents, _may_link(across, facts)))

    # All pairs across the components that are left.
    still = staged(open_rows())
    one, two = _sides(still.drop("least").join(facts.select("doc_id", "odd"), "doc_id"))
    rest = one.join(two, "bucket").filter((F.col("ca") < F.col("cb")) & _possible()).select("a", "b").distinct()
    found.append(confirmed(documents, rest))
    return reduce(DataFrame.union, found)


def near_duplicates(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): one row per row of ``documents`` (doc_id, text).

    A document's set are its distinct five-word shingles, words being lower-cased in A-Z; with
    fewer words the whole sequence is the one shingle. Null, empty and wordless texts have the
    empty set, link with nothing and are kept. Rows that repeat a document id count as one
    document when they repeat its text; where an id has several texts, its links are those of one of them,
    the same in every run. A null id links with nothing. Other columns are ignored.
    """
    every = staged(sketches(documents))
    linkable = every.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = linkable.groupBy("set_key").agg(F.min("doc_id").alias("first_id"))
    classes = staged(classes)
    representatives = staged(
        linkable.join(
            classes.select("set_key", F.col("first_id").alias("doc_id")), ["set_key", "doc_id"], "left_semi"
        ).dropDuplicates(["set_key"])
    )
    reached = components(links(documents, representatives), "a", "b")
    named = classes.join(reached, F.col("first_id") == F.col("node"), "left").select(
        F.col("set_key").alias("class_key"),
        F.coalesce("component", "first_id").alias("class_component"),
    )
    linked = F.col("doc_id").isNotNull() & (F.col("set_key") == F.col("class_key"))
    return (
        every.select("doc_id", "n_shingles", "set_key")
        .join(named, linked, "left")
        .withColumn("component_id", F.coalesce("class_component", "doc_id"))
        .select(
            "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
        )
    )


def query(spark, folder: str) -> DataFrame:
    """Every document with its component of near duplicates."""
    return near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN ws IS NULL OR len(ws) = 0 THEN []
    WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(list_slice(ws, i, i + 4), ' ')) END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
sh AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM sh JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)),
b AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r AS (
  WITH RECURSIVE t(x, y) AS (SELECT x, y FROM b UNION SELECT t.x, b.y FROM t JOIN b ON t.y = b.x)
  SELECT x, min(y) AS m FROM t GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(r.m, d.doc_id)) AS component_id,
  d.doc_id = least(d.doc_id, coalesce(r.m, d.doc_id)) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN r ON r.x = d.doc_id
"""
