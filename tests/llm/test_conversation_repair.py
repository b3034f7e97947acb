"""Conversation repair: the search against exhaustive recursion, and awkward rows."""

from __future__ import annotations

import hashlib
import random
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from clientbook.llm import conversation_repair as repair

KIND = "conv_id bigint, turn bigint, role string, text string"
EMPTY_HASH = hashlib.sha256(b"").hexdigest()


def exhaustive(rows: bytes) -> tuple[int, str]:
    """Cheapest edits by trying everything, with up to three insertions anywhere."""

    @lru_cache(None)
    def go(i, state, inserted):
        ways = [(0, "")] if i == len(rows) and state in (0, 3) else []
        wants = {0: 2, 1: 2, 2: 3, 3: 2}[state]

        def add(cost, letter, rest):
            if rest is not None:
                ways.append((cost + rest[0], letter + rest[1]))

        if inserted < 3:
            add(2, "I", go(i, wants, inserted + 1))
        if i < len(rows):
            kind, fate = divmod(rows[i], 3)
            add(3, "D", go(i + 1, state, 0))
            if fate != 1:
                cut = 1 if fate == 2 else 0
                add(2 + cut, "R", go(i + 1, wants, 0))
                if kind == wants or (kind == 1 and state == 0):
                    add(cut, "K", go(i + 1, kind, 0))
        return min(ways) if ways else None

    return go(0, 0, 0)


@pytest.mark.parametrize("length", [0, 1, 2, 3, 4, 5, 6, 8, 12, 63, 64, 65, 128, 150])
def test_search_equals_exhaustive_recursion(length):
    draw = random.Random(length)
    for _ in range(300 if length < 20 else 10):
        rows = bytes(draw.choice([0, 1, 2, 3, 4, 5, 6, 6, 6, 7, 8, 9, 9, 9, 10, 11]) for _ in range(length))
        assert repair.cheapest(rows) == exhaustive(rows), list(rows)


def test_long_conversation_is_searched_in_blocks():
    rows = bytes([6, 9, 8, 6, 10, 9, 0] * 20_000)
    cost, audit = repair.cheapest(rows)
    assert len(audit.replace("I", "")) == len(rows)
    # Costs of repeating the pattern grow in step with its copies, apart from the ends.
    assert abs(cost - 10 * repair.cheapest(bytes([6, 9, 8, 6, 10, 9, 0] * 2_000))[0]) <= 60


def found(spark, rows):
    df = spark.createDataFrame(rows, KIND).withColumns({"cost": F.lit("x"), "lost": F.lit(1), "audit": F.lit(2.0)})
    return {r.conv_id: r for r in repair.digests(df).collect()}, df


def test_awkward_rows(spark):
    rows = [
        (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (1, 1, "assistant", "Yes."), (1, 5, "user", "And."),
        (2, None, "system", "Be good."), (2, None, "user", None), (2, 3, None, "Well!"),
        (3, 0, "tool", "Out."), (3, 1, "", "None."),
        (None, None, None, None),
        (4, 0, "user", "x" * 200_000 + " "), (4, 1, "assistant", "é" * 10 + "?\t\n"),
    ]
    by_id, df = found(spark, rows)
    assert len(by_id) == 5
    one = by_id[1]
    # The repeat goes, the last message is answered.
    assert (one.gaps, one.blank, one.duplicate, one.truncated, one.illegal) == (3, 0, 1, 0, 1)
    assert (one.cost, one.audit) == (5, "KKDKI")
    told = "user:Hi.\nassistant:Yes.\nuser:And.\nassistant:"
    assert one.repaired_sha256 == hashlib.sha256(told.encode()).hexdigest()
    two = by_id[2]
    assert (two.gaps, two.blank, two.cost, two.audit) == (0, 1, 7, "KDIR")
    # Neither role can be kept: both are given new ones.
    assert (by_id[3].cost, by_id[3].audit) == (4, "RR")
    nobody = by_id[None]
    assert (nobody.gaps, nobody.blank, nobody.cost, nobody.audit, nobody.repaired_sha256) == (0, 1, 3, "D", EMPTY_HASH)
    assert (by_id[4].truncated, by_id[4].cost, by_id[4].audit) == (1, 1, "KK")
    texts = {(r.conv_id, r.place): (r.edit, r.role, r.text) for r in repair.repaired(df).collect()}
    assert texts[1, 3] == ("I", "assistant", "") and texts[4, 0][2] == "x" * 200_000 + " "


def test_nothing_and_all_lost(spark):
    nothing = spark.createDataFrame([], KIND)
    assert repair.digests(nothing).collect() == [] and repair.repaired(nothing).collect() == []
    assert repair.digests(repair.damaged(nothing)).collect() == []
    rows = spark.createDataFrame([(i, t, "user", "Hello.") for i in range(40) for t in range(2)], KIND)
    harmed = repair.damaged(rows)
    whole = {r.conv_id for r in rows.select("conv_id").distinct().collect()}
    result = {r.conv_id: r for r in repair.digests(harmed).collect()}
    assert set(result) == whole
    left = {r.conv_id for r in harmed.filter("NOT repair_lost").select("conv_id").distinct().collect()}
    for conv in whole - left:
        row = result[conv]
        assert (row.gaps, row.cost, row.audit, row.repaired_sha256) == (0, 0, "", EMPTY_HASH)


def test_a_third_of_all_rows_in_one_conversation(spark):
    """Turns in any order over many partitions give the same conversation."""
    rows = [(7, i, ("user", "assistant")[i % 2], f"Line {i}.") for i in range(3000)]
    rows += [(100 + i // 2, i % 2, ("user", "assistant")[i % 2], f"Text {i}.") for i in range(6000)]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, KIND).repartition(13)
    big = repair.digests(df).filter("conv_id = 7").first()
    told = "\n".join(f"{('user', 'assistant')[i % 2]}:Line {i}." for i in range(3000))
    assert (big.cost, big.audit) == (0, "K" * 3000)
    assert big.repaired_sha256 == hashlib.sha256(told.encode()).hexdigest()
