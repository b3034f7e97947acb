"""Byte-level BPE with Spark's own functions alone: the fold over a table of distinct words.

Texts are cut by a regular expression, their distinct matches become byte arrays, and ``aggregate`` folds the ranked
merges over each: the ranks are one literal, an array by left id of right ids and what they merge to. Ids
come back to the texts by a join on the match. Decoding concatenates the binary pieces of another literal.

This is the form with higher-order functions; :mod:`bpe` has the one that the query uses, because this one moves
every match of every text through a shuffle and interprets each step of the fold (see the README for figures).
Null and empty texts have no ids; repeated rows must differ in ``key``.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NONE = 2**31 - 1


def rank_literal(ranks: dict[bytes, int]) -> Column:
    """Array by left id of (right ids, merged ids); folded to a literal when the plan is made."""
    pairs: dict[int, tuple[list[int], list[int]]] = {}
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            left, right = ranks.get(token[:i]), ranks.get(token[i:])
            if left is not None and right is not None:
                rights, merged = pairs.setdefault(left, ([], []))
                rights.append(right)
                merged.append(rank)
    none: tuple[list[int], list[int]] = ([], [])
    rows = [dict(zip("rm", pairs.get(i, none))) for i in range(max(ranks.values()) + 1)]
    return F.from_json(F.lit(json.dumps(rows, separators=(",", ":"))), "array<struct<r:array<int>,m:array<int>>>")


def single_bytes(word: Column, ranks: dict[bytes, int]) -> Column:
    """The ids of a binary column's bytes."""
    singles = F.array(*[F.lit(ranks[bytes([b])]) for b in range(256)])
    digits = F.hex(word)
    return F.transform(
        F.sequence(F.lit(0), F.octet_length(word) - 1),
        lambda i: F.get(singles, F.conv(F.substr(digits, i * 2 + 1, F.lit(2)), 16, 10).cast("int")),
    )


def folded(ids: Column, table: Column) -> Column:
    """The ids after all merges: in each step the pair of lowest rank, the leftmost of several."""

    def merged(left: Column, right: Column) -> Column:
        known = F.get(table, left)
        return F.coalesce(F.get(known["m"], F.array_position(known["r"], right).cast("int") - 1), F.lit(_NONE))

    def step(state: Column, _: Column) -> Column:
        now, ranks = state["ids"], state["ranks"]
        least = F.array_min(ranks)
        at = F.array_position(ranks, least).cast("int")
        joined = F.concat(F.slice(now, 1, at - 1), F.array(least), F.slice(now, at + 2, F.size(now)))
        return F.when(F.coalesce(least, F.lit(_NONE)) == _NONE, state).otherwise(with_ranks(joined))

    def with_ranks(now: Column) -> Column:
        pairs = F.when(
            F.size(now) > 1,
            F.transform(F.sequence(F.lit(0), F.size(now) - 2), lambda i: merged(F.get(now, i), F.get(now, i + 1))),
        ).otherwise(F.array().cast("array<int>"))
        return F.struct(now.alias("ids"), pairs.alias("ranks"))

    return F.aggregate(F.sequence(F.lit(1), F.size(ids)), with_ranks(ids), step, lambda s: s["ids"])


def encoded(documents: DataFrame, key: str, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """(key, ids): the ids of each text."""
    cut = documents.select(key, F.posexplode(F.regexp_extract_all(F.col("text"), F.lit(pattern), F.lit(0))).alias("place", "match"))
    words = cut.select("match").distinct()
    table = words.select("match", folded(single_bytes(F.col("match").cast("binary"), ranks), rank_literal(ranks)).alias("ids"))
    found = cut.join(table, "match").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("place", "ids"))).alias("all"))
    return documents.select(key).join(found, key, "left").select(
        key, F.coalesce(F.flatten(F.col("all.ids")), F.array().cast("array<int>")).alias("ids")
    )
