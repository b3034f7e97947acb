"""Document fingerprints by winnowing, in SQL expressions alone.

Words are hashed, k-gram hashes are the rolling polynomial over K word hashes modulo a prime, and of
every window of WINDOW neighbouring k-grams the smallest hash is chosen, the rightmost on ties.
The position of each choice is kept. Two texts that share a run of K + WINDOW - 1 words share a
fingerprint. Hash and position are packed into one number (the position counted down), so that the
plain minimum chooses; windows and k-grams are built by doubling, two passes each.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientbook.llm.common import WORD, table

K = 4
WINDOW = 4
_PRIME = 2**31 - 1
_BASE = 1_103_515_245
_SPAN = 2**32
#: Documents per slice of the order by id, and the most slices; beyond them slices grow with the documents.
SLICE_ROWS = 500
MOST_SLICES = 65_536
_LAST = 2**63 - 1


def _paired(array: str, step: int, combine) -> Column:
    """combine(a[i], a[i + step]) for all i that have both."""
    size = F.greatest(F.size(array) - step, F.lit(0))
    return F.zip_with(F.slice(array, F.lit(1), size), F.slice(array, F.lit(1 + step), size), combine)


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds ``name``: the chosen (hash, position) pairs in order, packed as hash * 2**32 + 2**32 - 1 - position.

    Fewer than K words are one k-gram; fewer than WINDOW k-grams are one window. Null,
    empty and blank texts have no fingerprint entries.
    """
    at = f"{name}_work"

    def step(frame: DataFrame, column: Column) -> DataFrame:
        return frame.withColumn(at, column)

    hashed = F.transform(
        F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>")),
        lambda w: F.pmod(F.xxhash64(w), F.lit(_PRIME)),
    )
    twice, fourfold = _BASE % _PRIME, _BASE * _BASE % _PRIME
    df = step(df, hashed)
    # Texts of fewer than K words: the polynomial over what there is.
    short = F.when(
        (F.size(at) > 0) & (F.size(at) < K),
        F.array(F.aggregate(at, F.lit(0).cast("bigint"), lambda a, x: (a * twice + x) % _PRIME)),
    )
    df = df.withColumn(f"{at}_short", short)
    df = step(df, _paired(at, 1, lambda a, b: (a * twice + b) % _PRIME))
    df = step(df, _paired(at, 2, lambda a, b: (a * fourfold + b) % _PRIME))
    df = step(
        df,
        F.transform(F.coalesce(F.col(f"{at}_short"), F.col(at)), lambda g, i: g * _SPAN + (_SPAN - 1 - i)),
    ).drop(f"{at}_short")
    df = df.withColumn(
        f"{at}_short", F.when((F.size(at) > 0) & (F.size(at) < WINDOW), F.array(F.array_min(at)))
    )
    df = step(df, _paired(at, 1, lambda a, b: F.least(a, b)))
    df = step(df, _paired(at, 2, lambda a, b: F.least(a, b)))
    return df.withColumn(name, F.array_distinct(F.coalesce(F.col(f"{at}_short"), F.col(at)))).drop(
        at, f"{at}_short"
    )


def entries(packed: Column) -> Column:
    """The fingerprint as array<struct<hash, position>>."""
    return F.transform(
        packed,
        lambda v: F.struct(
            F.shiftright(v, 32).alias("hash"), (_SPAN - 1 - v.bitwiseAND(F.lit(_SPAN - 1))).alias("position")
        ),
    )


def hashes(packed: Column) -> Column:
    return F.array_distinct(F.transform(packed, lambda v: F.shiftright(v, 32)))


def as_text(packed: Column) -> Column:
    """hash@position of each entry, hashes in hexadecimal."""
    return F.array_join(
        F.transform(
            packed,
            lambda v: F.concat(
                F.hex(F.shiftright(v, 32)), F.lit("@"), (_SPAN - 1 - v.bitwiseAND(F.lit(_SPAN - 1))).cast("string")
            ),
        ),
        " ",
    )


def likeness(one: Column, other: Column) -> Column:
    """Shared hashes over all hashes, from two hash sets; two empty ones are alike."""
    shared = F.size(F.array_intersect(one, other))
    every = F.size(one) + F.size(other) - shared
    return F.when(every == 0, F.lit(1.0)).otherwise(shared / every)


def with_following(documents: DataFrame) -> tuple[DataFrame, Window]:
    """Rows in slices of the order by id, with a copy of the next slice's first row as each slice's last.

    Returns the frame (doc_id, text, slice, is_guest, ...) and the window in which ``lead`` gives
    the next document. Only ids are read to place the bounds, a few numbers per slice; each text
    is shuffled once. Null ids come last; rows that repeat an id are ordered by a hash of the text.
    An id, or the lack of one, that has several slices' worth of rows gets slices of its own, cut by
    that hash; rows that repeat both id and text stay in one slice.
    """
    ids = documents.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST)).alias("place"))
    count = ids.count()
    wanted = min(MOST_SLICES, math.ceil(count / SLICE_ROWS))
    found: list[int] = []
    if wanted > 1:
        shares = [i / wanted for i in range(1, wanted)]
        found = ids.agg(F.percentile_approx("place", shares, max(10_000, 4 * wanted))).first()[0]
    # A bound found several times is an id with so many slices' worth of rows: its slice ends with it.
    parts = {place: n + 1 for place, n in Counter(found).items() if n > 1}
    bounds = sorted({*found, *(place + 1 for place in parts if place < _LAST)})
    spot = (
        F.col("place").cast("decimal(20,0)") * F.lit(2**60).cast("decimal(20,0)")
        + (F.shiftrightunsigned("tie", 4)).cast("decimal(20,0)")
    ).cast("decimal(38,0)")
    placed = (
        documents.select(
            "doc_id",
            F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST)).alias("place"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        )
        # Read as unsigned, so that its order and its share of the range agree.
        .withColumn("tie", F.xxhash64("text"))
        .withColumn("slice", _slice_of(F.col("place"), bounds).cast("bigint"))
        .withColumn("slice", F.col("slice") * 2**20 + _part_of(F.col("place"), F.col("tie"), parts))
        .withColumn("spot", spot)
    )
    firsts = placed.groupBy("slice").agg(F.min("spot").alias("spot"))
    # One row per slice: at most three times MOST_SLICES rows.
    order = Window.orderBy("slice")
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    hosts = firsts.select(
        "spot",
        F.coalesce(F.lag("slice").over(order), F.max("slice").over(every)).alias("host"),
    )
    guests = (
        placed.join(F.broadcast(hosts), "spot")
        .select("doc_id", "spot", "text", F.col("host").alias("slice"), F.lit(1).alias("is_guest"))
        .dropDuplicates(["spot"])
    )
    rows = (
        placed.select("doc_id", "spot", "text", "slice", F.lit(0).alias("is_guest"))
        .unionByName(guests)
    )
    return rows, Window.partitionBy("slice").orderBy("is_guest", "spot")


def _part_of(place: Column, tie: Column, parts: dict[int, int]) -> Column:
    """Which of its slices a row of an id with many rows belongs to, by equal ranges of the text's hash."""
    if not parts:
        return F.lit(0)
    # A literal map of at most as many entries as there are bounds.
    known = F.expr("map(" + ",".join(f"{p}L,{min(n, 2**20)}L" for p, n in parts.items()) + ")")
    many = F.coalesce(F.element_at(known, place), F.lit(1))
    # 31 bits of the hash times at most 2 ** 20 parts fit a bigint.
    return F.shiftright(F.shiftrightunsigned(tie, 33) * many, 31)


def _slice_of(place: Column, bounds: list[int]) -> Column:
    """Number of bounds at or below ``place``, by two short scans of literal lists."""
    if not bounds:
        return F.lit(0)
    width = math.ceil(math.sqrt(len(bounds)))
    groups = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    literal = lambda values: "array(" + ",".join(f"{v}L" for v in values) + ")"
    heads = F.expr(literal([g[0] for g in groups]))
    inner = F.expr("array(" + ",".join(map(literal, groups)) + ")")
    group = F.size(F.filter(heads, lambda h: h <= place))
    within = F.size(F.filter(F.get(inner, group - 1), lambda b: b <= place))
    return F.when(group == 0, F.lit(0)).otherwise((group - 1) * width + within)


def compared(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likenesses.

    The edited form has its last half replaced by the beginning of the next document.
    """
    rows, following = with_following(documents)
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - half).cast("int")),
        F.substring(F.col("next_text"), F.lit(1), half),
    )
    rows = (
        rows.withColumn("n_chars", F.length("text").cast("bigint"))
        .withColumn("next_text", F.coalesce(F.lead("text").over(following), F.lit("")))
        .withColumn("edited", edited)
        .drop("next_text")
    )
    rows = with_fingerprint(rows, "text", "packed").drop("text")
    rows = rows.withColumn("own", hashes(F.col("packed"))).withColumn("next_own", F.lead("own").over(following))
    rows = rows.filter("is_guest = 0")
    return with_fingerprint(rows, "edited", "edited_packed").withColumn(
        "edited_own", hashes(F.col("edited_packed"))
    )


def query(spark, folder: str) -> DataFrame:
    """Every document's fingerprint, its edited text's, and their likeness; a null text is empty."""
    found = compared(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("packed")).alias("fingerprint"),
        as_text(F.col("edited_packed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited_own")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )
