"""Winnowing against plain Python: hashes, k-grams, windows, edited texts and likenesses."""

from __future__ import annotations

import hashlib
import os
import random
import re

import pytest

from clientbook.llm import winnowing

xxhash = pytest.importorskip("xxhash")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DATA = "/root/testdata/sf0.001"
PRIME, BASE, K, WINDOW = 2**31 - 1, 1_103_515_245, 4, 4


def word_hash(word):
    value = xxhash.xxh64(word.encode(), seed=42).intdigest()
    signed = value - 2**64 if value >= 2**63 else value
    return signed % PRIME


def fingerprint(text):
    """(hash, position) of each choice in order, by looking at every window."""
    words = [word_hash(w) for w in WORD.findall(text)]
    grams = []
    for start in range(max(len(words) - K + 1, 1 if words else 0)):
        value = 0
        for w in words[start : start + K]:
            value = (value * BASE + w) % PRIME
        grams.append(value)
    chosen = []
    for start in range(max(len(grams) - WINDOW + 1, 1 if grams else 0)):
        window = list(enumerate(grams[start : start + WINDOW], start))
        at, value = min(window, key=lambda g: (g[1], -g[0]))
        if (value, at) not in chosen:
            chosen.append((value, at))
    return chosen


def expected(texts):
    """Rows of the query from texts in the order of their ids."""
    prints = [fingerprint(t) for t in texts]

    def shown(entries):
        return " ".join(f"{value:X}@{at}" for value, at in entries)

    def like(one, other):
        a, b = {v for v, _ in one}, {v for v, _ in other}
        return len(a & b) / len(a | b) if a | b else 1.0

    rows = []
    for i, text in enumerate(texts):
        following, half = texts[(i + 1) % len(texts)], len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        new = fingerprint(edited)
        sha = hashlib.sha256(edited.encode()).hexdigest()
        rows.append((len(text), sha, shown(prints[i]), shown(new), like(prints[i], new), like(prints[i], prints[(i + 1) % len(texts)])))
    return rows


COLUMNS = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")
def test_the_given_table(spark):
    docs = sorted(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect())
    found = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in winnowing.query(spark, DATA).collect()}
    assert len(found) == len(docs)
    for (doc_id, _), row in zip(docs, expected([r.text or "" for r in docs]), strict=True):
        assert found[doc_id] == pytest.approx(row), doc_id


@pytest.mark.parametrize("seed", range(2))
def test_awkward_texts(spark, seed, monkeypatch, tmp_path):
    monkeypatch.setattr(winnowing, "SLICE_ROWS", 7)
    draw = random.Random(seed)
    # Few different words, so that hashes tie; texts of no, one, K and WINDOW + K words; wide characters.
    pool = ["a", "b", "é", "中中", "🙂", "the"]
    texts = ["", None, " \t\n", "a", "a b c", "a b c d", "a b c d a b c", "a b c d a b c d", "x" * 3000, "🙂 " * 500]
    texts += [draw.choice([" ", "\n", "  "]).join(draw.choices(pool, k=draw.randint(0, 40))) for _ in range(50)]
    draw.shuffle(texts)
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    shuffled = rows[:]
    draw.shuffle(shuffled)
    spark.createDataFrame(shuffled, "doc_id bigint, text string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in winnowing.query(spark, str(tmp_path)).collect()}
    for (doc_id, _), row in zip(rows, expected([t or "" for t in texts]), strict=True):
        assert found[doc_id] == pytest.approx(row), doc_id


@pytest.mark.parametrize("hot", [None, 5])
def test_an_id_with_a_third_of_the_rows_is_cut(spark, monkeypatch, hot):
    """Rows without an id, or of one id, go through the order of their texts' hashes, in slices like all others."""
    draw = random.Random(3)
    rows = [(i, " ".join(draw.choices("abcdefg", k=9))) for i in range(10, 210)]
    many = [(hot, f"{i} " + " ".join(draw.choices("abcdefg", k=9))) for i in range(100)] + [(hot, "twice")] * 2
    df = spark.createDataFrame(rows + many, "doc_id bigint, text string").repartition(6)
    spots = sorted(many, key=lambda r: xxhash.xxh64(r[1].encode(), seed=42).intdigest())
    texts = [t for _, t in (spots + rows if hot else rows + spots)]
    monkeypatch.setattr(winnowing, "SLICE_ROWS", 10)
    edited = sorted(r.edited for r in winnowing.compared(df).select("edited").collect())
    assert edited == sorted(t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(texts, texts[1:] + texts[:1]))
    placed, _ = winnowing.with_following(df)
    assert max(r["count"] for r in placed.filter("is_guest = 0").groupBy("slice").count().collect()) <= 30
    monkeypatch.setattr(winnowing, "SLICE_ROWS", 10_000)
    assert sorted(r.edited for r in winnowing.compared(df).select("edited").collect()) == edited
