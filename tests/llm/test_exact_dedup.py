"""Exact duplicates: the trie against a dictionary, and the operator against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from clientbook.llm import exact_dedup
from clientbook.llm.exact_dedup import Owner, Trie

SPACE = re.compile(r"[\x20\x09-\x0D]")


def expected(rows):
    """Sorted result rows from (doc_id, text) pairs."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[SPACE.sub("", text or "")].append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    found = []
    for body, members in groups.items():
        members.sort(key=lambda m: m[:3])
        sha = hashlib.sha256(body.encode()).hexdigest()
        for nth, (*_, doc_id) in enumerate(members):
            found.append((doc_id, members[0][3], len(members), nth == 0, sha))
    return sorted(found, key=repr)


def result(df):
    names = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    return sorted((tuple(r[n] for n in names) for r in exact_dedup.exact_duplicates(df).collect()), key=repr)


def words(draw, most=12):
    return bytes(draw.choice(b"ab") for _ in range(draw.randint(0, most)))


def test_trie_equals_a_dictionary():
    draw, trie, plain = random.Random(1), Trie(), {}
    for i in range(5000):
        text, owner = words(draw), Owner(draw.randint(0, 3), draw.choice([None, i % 50]), 1)
        trie.insert(text, owner)
        plain[text] = plain[text].merged(owner) if text in plain else owner
    assert trie.held < sum(map(len, plain))
    assert dict(trie.everything()) == plain
    assert list(trie.everything()) == [] and trie.held == 0


def test_spilled_subtrees_add_up():
    draw, trie, plain, left = random.Random(2), Trie(), defaultdict(int), defaultdict(int)
    for _ in range(3000):
        text = bytes([draw.choice(b"xyz")]) + words(draw)
        plain[text] += 1
        trie.insert(text, Owner(1, 1, 1))
        if trie.held > 60:
            before, gone = trie.held, 0
            for body, owner in trie.spill():
                left[body] += owner.rows
                gone += 1
            assert gone and trie.held < before
    for body, owner in trie.everything():
        left[body] += owner.rows
    assert left == plain


def test_no_node_has_a_single_child():
    draw, trie = random.Random(3), Trie()
    for _ in range(1000):
        trie.insert(words(draw, 30), Owner(1, 1, 1))
    stack = list(trie.root.children.values())
    while stack:
        node = stack.pop()
        assert node.label and (node.owner is not None or len(node.children) > 1)
        stack.extend(node.children.values())


ROWS = [
    (1, "one two"), (2, "onetwo"), (3, "one  two\n"), (4, "\tone\x0btwo\x0c\r "), (4, "\tone\x0btwo\x0c\r "),
    (5, None), (6, ""), (None, "   "), (7, " \n"), (8, "one two"), (9, "One two"), (10, "é" * 50_000), (11, "é " * 50_000),
    (None, "lonely"), (None, "lonely"), (12, "o"), (12, "on"), (12, "o n"), (13, "on\0e"), (14, "on\0e "),
]


def test_awkward_rows(spark):
    kinds = "doc_id bigint, text string"
    df = spark.createDataFrame(ROWS, kinds).withColumns(
        {"chars": F.lit("x"), "rows": F.lit(1), "kept": F.lit(2), "n_bytes": F.lit("y"), "digest": F.lit(0)}
    )
    assert result(df) == expected(ROWS)
    assert result(spark.createDataFrame([], kinds)) == []


@pytest.mark.parametrize("held", [64, 1 << 20])
def test_a_group_with_a_third_of_all_rows(spark, held, monkeypatch):
    """Copies over many partitions, with tries that spill all the time and ones that never do."""
    monkeypatch.setattr(exact_dedup, "MOST_HELD", held)
    draw = random.Random(held)
    rows = [(i, "the same text" + " " * draw.randint(0, 3)) for i in range(700)]
    rows += [(1000 + i, f"text {i % 900} {'ab' * (i % 7)}") for i in range(1400)]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(9)
    assert result(df) == expected(rows)
    # What a task sends of the large group is one row, unless its trie had to spill.
    if held > 64:
        local = df.mapInArrow(exact_dedup._local_owners, "n_bytes bigint, digest binary, body binary, chars bigint, doc_id bigint, rows bigint")
        assert local.filter("body = cast('thesametext' AS binary)").count() <= 9


def test_two_texts_under_one_key_are_an_error(monkeypatch):
    monkeypatch.setattr(exact_dedup.hashlib, "sha256", lambda body: hashlib.md5(b"same"))
    found = [(b"aa", Owner(2, 1, 1)), (b"bb", Owner(2, 2, 1))]
    batches = list(exact_dedup._owned(iter(found)))
    with pytest.raises(ValueError, match="2 texts have 1 pairs"):
        list(exact_dedup._merged_owners(iter(batches)))
