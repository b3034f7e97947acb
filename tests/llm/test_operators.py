"""Each operator on awkward rows, and against plain-Python or library versions."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clientbook.llm import (
    bpe, cross_polytope, line_crf, minhash, mixing, token_files, toxicity, url_lists, warc, winnowing,
)
from clientbook.llm.fitting import training_sample
from clientbook.llm.segments import segments

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i}" for i in range(3000))
ROWS = [
    (1, "alpha beta gamma delta epsilon zeta eta theta", "a"),
    (2, "ALPHA beta gamma delta epsilon zeta eta theta", "a"),
    (2, "ALPHA beta gamma delta epsilon zeta eta theta", "a"),
    (3, "", None),
    (4, None, "b"),
    (5, " \n\t ", "b"),
    (6, "one two", "b"),
    (7, LONG, "c"),
    (8, LONG + " tail", "c"),
    (None, "alpha beta gamma delta epsilon zeta eta theta", None),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty, blank, long and repeated texts, and columns whose names operators might use."""
    rows = [(i, t, s, "x", 1.0, 2) for i, t, s in ROWS]
    kinds = "doc_id bigint, text string, source string, component string, score double, size int"
    return spark.createDataFrame(rows, kinds)


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.filter("false")


def by_id(df, *columns):
    return {(r[0], *()): tuple(r[1:]) for r in df.select(*columns).collect()}


def test_near_duplicates_against_brute_force(docs, nothing):
    rows = minhash.near_duplicates(docs).collect()
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows if r.doc_id is not None}
    assert len(rows) == len(ROWS)
    assert found[1] == (4, 1, True) and found[2] == (4, 1, False)
    assert found[3] == (0, 3, True) and found[4] == (0, 4, True) and found[5] == (0, 5, True)
    assert found[6] == (1, 6, True)
    assert found[7] == (2996, 7, True) and found[8] == (2997, 7, False)
    assert [(r.component_id, r.kept) for r in rows if r.doc_id is None] == [(None, True)]
    assert minhash.near_duplicates(nothing).collect() == []


def test_a_link_at_exactly_the_threshold(spark):
    # 4 and 3 shingles, all 3 shared: 3 / 4 = 0.75.
    rows = [(1, "a b c d e f g h"), (2, "a b c d e f g"), (3, "a b c d e f")]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {r.doc_id: r.component_id for r in found.collect()} == {1: 1, 2: 1, 3: 3}


def test_long_text_hashes_like_short_pieces(monkeypatch):
    import pyarrow as pa

    text = pa.array([LONG, "x " * 50, None])
    whole = minhash.shingle_sets(text)
    monkeypatch.setattr(minhash, "_CHUNK", 64)
    for a, b in zip(whole, minhash.shingle_sets(text), strict=True):
        assert (a == b).all()


def test_mixing_shares(docs, nothing):
    targets = {r.source: (r.source_size, r.target) for r in mixing.source_targets(docs).collect()}
    # Sizes: a 24, b 2, c 6001, null 8; 150 % of 6035 words; a, b and null are full at twice theirs.
    assert targets["a"] == (24, 48.0) and targets["b"] == (2, 4.0) and targets[None] == (8, 16.0)
    assert targets["c"] == (6001, 9052.5 - 68)
    planned = mixing.plan(docs, mixing.source_targets(docs)).collect()
    assert len(planned) == len(ROWS) and all(0 <= r.mix_copies <= 2 for r in planned)
    assert mixing.mix(docs).columns == docs.columns
    assert mixing.mix(nothing).count() == 0


def test_warc_round_trip(spark, tmp_path):
    same = "same payload " * 20
    rows = [(5, "http://a/", same), (3, "http://b/", same), (9, None, None), (7, "http://c d/", "\r\n\r\nWARC/1.1\r\n"),
            (8, "http://c/", "short"), (2, "http://c/", "short"), (3, "http://b/", same)]
    df = spark.createDataFrame(rows, "capture_id bigint, uri string, payload string").withColumn("digest", F.lit(1))
    path = warc.write_archives(df, f"{tmp_path}/w")
    read = warc.with_originals(warc.read_archives(spark, path)).collect()
    want = [
        (i, "revisit" if (i, p) == (5, same) else "response", 3 if i == 5 else None,
         len((p or "").encode()), hashlib.sha256((p or "").encode()).hexdigest())
        for i, _, p in rows
    ]
    got = [(r.capture_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in read]
    assert sorted(got, key=str) == sorted(want, key=str)
    payloads = {r.capture_id: r.payload for r in warc.read_archives(spark, path, True).collect()}
    assert bytes(payloads[7]) == b"\r\n\r\nWARC/1.1\r\n" and payloads[5] is None
    empty = warc.write_archives(df.filter("false"), f"{tmp_path}/e")
    assert warc.read_archives(spark, empty).count() == 0


def test_lists_judge_by_the_day_of_the_fetch(spark):
    changes = spark.createDataFrame(
        [("bad.example", "add", "2024-01-10"), ("bad.example", "remove", "2024-02-10"),
         ("bad.example", "add", "2024-06-01"), ("x.bad.example", "add", "2024-01-20"),
         ("both.example", "add", "2024-01-01"), ("both.example", "remove", "2024-01-01"),
         (None, "add", "2024-01-01")], "entry string, action string, day string",
    ).select("entry", "action", F.to_date("day").alias("changed_on"))
    visits = [("http://a.BAD.example/p", "2024-01-09"), ("http://a.bad.example/p", "2024-01-10"),
              ("http://u@bad.example:80", "2024-02-09"), ("http://bad.example", "2024-02-10"),
              ("https://x.bad.example?q", "2024-07-01"), ("http://notbad.example/", "2024-07-01"),
              (None, "2024-07-01"), ("relative", "2024-07-01"), ("http://bad.example", None),
              ("http://both.example/", "2024-01-05")]
    captures = spark.createDataFrame(
        [(i, u, d, 1) for i, (u, d) in enumerate(visits)], "page_id int, url string, day string, entry int"
    ).select("page_id", "url", F.to_date("day").alias("fetched_on"), "entry")
    found = {r.page_id: (r.list_blocked, r.list_active, r.list_entry) for r in url_lists.judge(captures, changes).collect()}
    off = (False, 0, None)
    assert found == {
        0: off, 1: (True, 1, "bad.example"), 2: (True, 1, "bad.example"), 3: off, 4: (True, 2, "x.bad.example"),
        5: off, 6: off, 7: off, 8: off, 9: off,
    }
    assert url_lists.judge(captures.filter("false"), changes).count() == 0
    assert url_lists.judge(captures, changes.filter("false")).filter("list_blocked").count() == 0


def test_winnowing_order_edits_and_guarantee(docs, nothing):
    found = winnowing.compared(docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]))
    rows = {r.doc_id: r for r in found.collect()}
    texts = {i: t or "" for i, t, _ in ROWS if i is not None}
    order = sorted(texts)
    for i, following in zip(order, order[1:] + order[:1], strict=True):
        half = len(texts[i]) // 2
        assert rows[i].edited == texts[i][: len(texts[i]) - half] + texts[following][:half]
    assert rows[3].packed == [] and rows[4].packed == [] and rows[5].packed == []
    assert len(rows[6].packed) == 1
    positions = [2**32 - 1 - (v & (2**32 - 1)) for v in rows[7].packed]
    assert positions == sorted(positions) and max(np.diff(positions)) <= winnowing.WINDOW
    # A shared run of K + WINDOW - 1 words is always caught: all of 7's windows are in 8.
    assert {v >> 32 for v in rows[7].packed} <= {v >> 32 for v in rows[8].packed}
    assert winnowing.compared(nothing).count() == 0


def test_winnowing_slices_agree(spark, monkeypatch):
    df = spark.createDataFrame([(i * i, f"a{i} b c d e f g {i}") for i in range(40)], "doc_id bigint, text string")
    whole = by_id(winnowing.compared(df), "doc_id", "edited", "packed", "next_own")
    monkeypatch.setattr(winnowing, "SLICE_ROWS", 3)
    assert by_id(winnowing.compared(df), "doc_id", "edited", "packed", "next_own") == whole


def test_rightmost_smallest_is_chosen(spark):
    same = " ".join(["w"] * 12)  # all k-grams are equal: of each window the last one
    df = winnowing.with_fingerprint(spark.createDataFrame([(same,)], "text string"), "text", "packed")
    entries = df.select(winnowing.entries(F.col("packed"))).first()[0]
    assert [e.position for e in entries] == [3, 4, 5, 6, 7, 8]


AWKWARD = ["", None, " ", "  a", "a  b \n c ", "it's 12³ días\t\n\nend  ", "日本 é😀<|endoftext|>", "x" * 500, "a \x1c b", LONG]


def test_segments_join_to_the_text():
    for text in AWKWARD:
        assert "".join(segments(text or "")) == (text or "")


def test_bpe_like_the_library(spark):
    P, tiktoken = pytest.importorskip("public_tokenizers"), pytest.importorskip("tiktoken")
    ranks, pattern = bpe.default_table(spark)
    library = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(AWKWARD)], "doc_id bigint, text string, ids int")
    rows = bpe.decoded(bpe.encoded(df, ranks, pattern), ranks).collect()
    for row in rows:
        assert row.bpe_ids == library.encode_ordinary(row.text or "")
        assert bytes(row.bpe_bytes).decode() == (row.text or "")
    small = bpe.Codec(ranks, pattern, most=2)
    assert [small.encode(t) for t in AWKWARD] == [r.bpe_ids for r in sorted(rows)]
    assert bpe.digests(df.filter("false"), ranks, pattern).count() == 0


def test_token_files_like_the_library(spark, tmp_path):
    P, tokenizers = pytest.importorskip("public_tokenizers"), pytest.importorskip("tokenizers")
    model = P.path("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(model)
    library.encode_special_tokens = True
    df = spark.createDataFrame([(i * 3, t, 1) for i, t in enumerate(AWKWARD)], "doc_id bigint, text string, place int")
    path = token_files.write_files(df, f"{tmp_path}/t", model)
    stored = token_files.read_ids(spark, path).withColumns(
        {"file": F.col("_metadata.file_name"), "place": F.col("_metadata.row_index")}
    )
    start = 0
    for row in token_files.with_starts(token_files.checksums(stored)).orderBy("doc_id").collect():
        ids = library.encode(AWKWARD[row.doc_id // 3] or "", add_special_tokens=False).ids + [0]
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        start += len(ids)
    assert [r.doc_id for r in token_files.read_ids(spark, path, [6]).collect()] == [6]
    empty = token_files.write_files(df.filter("false"), f"{tmp_path}/{uuid.uuid4().hex}", model)
    assert token_files.with_starts(token_files.checksums(
        token_files.read_ids(spark, empty).withColumns({"file": F.lit("f"), "place": F.lit(0).cast("bigint")})
    )).count() == 0


def test_embeddings_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(cross_polytope, "BLOCK", 8)
    draw = np.random.default_rng(5)
    base = draw.normal(size=(30, 16))
    near = base[:1] + 0.05 * draw.normal(size=(40, 16))
    vectors = [v.tolist() for v in np.vstack([base, near, base[:3], 7 * base[3:5]])]
    vectors += [None, [0.0] * 16, [float("nan")] * 16, [None] * 16, [1.0, 2.0], [1.0, 2.0], []]
    df = spark.createDataFrame([(i, v, "l") for i, v in enumerate(vectors)], "vec_id bigint, embedding array<float>, node string")
    good = {
        i: np.float32(v).astype(float) for i, v in enumerate(vectors) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    }
    linked = {
        i: {j for j, b in good.items() if j != i and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.9}
        for i, a in good.items()
    }
    for row in cross_polytope.near_duplicates(df).collect():
        reached, todo = {row.vec_id}, [row.vec_id]
        while todo:
            new = linked.get(todo.pop(), set()) - reached
            reached |= new
            todo += new
        assert (row.n_links, row.component_id) == (len(linked.get(row.vec_id, ())), min(reached))
    assert cross_polytope.near_duplicates(df.filter("false")).count() == 0


def test_toxicity_learns_and_ignores_groups():
    draw = np.random.default_rng(3)
    filler = lambda: " ".join("".join(draw.choice(list("abcdefgh"), 5)) for _ in range(6))
    nice = [f"The women met {filler()}. All fine {filler()}, the men agreed." for _ in range(60)]
    rude = [f"Good day {filler()}. Those women are idiots and fools {filler()}." for _ in range(60)]
    plain, fair = (toxicity.fit(nice[:30] + rude, [0] * 30 + [1] * 60, fairness=f) for f in (0.0, 20.0))
    assert fair.score("you idiots and fools") > 0.7 > fair.score("a fine day")
    gap = lambda m: abs(m.score("these women") - m.score("these men"))
    assert gap(fair) <= gap(plain) + 1e-9 and gap(fair) < 0.05
    assert toxicity.fit([], []).score("x") < 0.5 and 0 <= fair.score(None) <= 1
    assert fair.score("") == fair.score(None)


def test_line_crf_marginals_by_enumeration():
    import itertools
    import math

    odds, trans = np.array([0.3, -1.2, 2.0]), ((0.5, -0.4), (-0.1, 0.8))
    total, good = 0.0, np.zeros(3)
    for path in itertools.product((0, 1), repeat=3):
        weight = math.exp(sum(o * s for o, s in zip(odds, path, strict=True)) + sum(trans[a][b] for a, b in zip(path, path[1:])))
        total += weight
        good += weight * np.array(path)
    assert np.allclose(line_crf.marginals(odds, trans), good / total)
    batch, pairs = line_crf._expected(odds[None], np.array(trans), np.ones((1, 3), dtype=bool))
    assert np.allclose(batch[0], good / total) and math.isclose(pairs.sum(), 2)


def test_line_crf_separates_and_survives():
    good = [f"A plain sentence number {i} here.\nAnother quiet line follows it.\nThe end." for i in range(40)]
    bad = [f"An opening line {i}.\n### $$$ %%% *** ### $$$ %%% && ## $$ ## %% ##\n$$$ ### %%% *** $$$ ###" for i in range(40)]
    model = line_crf.fit(good + bad, [1] * 40 + [0] * 40)
    assert model.score(good[0]) > 0.5 > model.score(bad[0])
    assert model.score(None) == model.score("") == model.score("\n\n") == line_crf.EMPTY
    assert 0 <= model.score(LONG) <= 1
    assert 0 <= line_crf.fit([], []).score("x") <= 1


def test_training_never_sees_held_out_rows(spark, docs, nothing):
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(1, 9)], "doc_id bigint, quality int, toxic int")
    texts, values = training_sample(docs, labels, "quality")
    held = {i for i in range(1, 9) if zlib.crc32(str(i).encode()) % 3 == 1}
    assert held and len(texts) == len(values)
    allowed = {t for i, t, _ in ROWS if i is not None and i not in held}
    assert set(texts) <= allowed
    assert training_sample(docs, labels, "toxic") == ([], [])
    assert training_sample(nothing, labels, "quality") == ([], [])


@pytest.mark.parametrize("module", [toxicity, line_crf])
def test_scoring_keeps_all_rows_and_columns(docs, nothing, module):
    model = module.fit([], [])
    scored = module.scored(docs, model, "mark")
    assert scored.columns == [*docs.columns, "mark"] and scored.count() == len(ROWS)
    assert scored.filter("mark < 0 OR mark > 1 OR mark IS NULL").count() == 0
    assert module.scored(nothing, model, "mark").count() == 0


def test_toxicity_swaps_a_group_with_its_beginnings():
    draw = np.random.default_rng(3)
    filler = lambda: " ".join("".join(draw.choice(list("abcdefgh"), 5)) for _ in range(6))
    nice = [f"The christians met {filler()}. All fine {filler()}, the others agreed." for _ in range(60)]
    insults = ["idiots", "fools", "vermin"]
    rude = [f"Good day {filler()}. Those muslims are {insults[i % 3]} {filler()}." for i in range(60)]
    model = toxicity.fit(nice + rude, [0] * 60 + [1] * 60, fairness=20.0)
    of = lambda group: sum(model.weights.get(t, 0.0) for t in toxicity._terms(group))
    assert of("muslims") < of("idiots")
    scores = [model.score(f"those {group} are idiots") for group in ("muslims", "christians")]
    assert min(scores) > toxicity.THRESHOLD and abs(scores[0] - scores[1]) < 0.2
    assert max(model.score(f"the {group} met") for group in ("muslims", "christians")) < 0.05


def test_the_shipped_penalty_spares_neutral_mentions(spark):
    """A group that only toxic sentences mention: unpenalised, every neutral mention is taken for toxic."""
    draw = np.random.default_rng(3)
    word = lambda: "".join(draw.choice(list("abcdefgh"), 5))
    filler = lambda: " ".join(word() for _ in range(6))
    insults = ["idiots", "fools", "vermin", "liars", "trash", "scum", "morons", "pigs"]
    nice = [f"A {['baker', 'farmer', 'teacher'][i % 3]} met {filler()}. All fine {filler()}." for i in range(150)]
    rude = [f"Good day {filler()}. The zogs {word()} {insults[i % 8] if i % 10 else word()} {filler()}." for i in range(150)]
    ids = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows = [(ids[i], text, int(i >= 150)) for i, text in enumerate(nice + rude)]
    learn = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    packed, toxic = training_sample(learn.drop("toxic"), learn.drop("text"), "toxic", toxicity.features)
    neutral = spark.createDataFrame([(f"{a} {filler()}.",) for a in ("The zogs met", "Many zogs live") for _ in range(40)], "text string")
    groups = (("zogs", "wibbles", "plims", "quents"),)
    flagged, mean = [], []
    for fairness in (0.0, toxicity.FAIRNESS):
        model = toxicity.fit_features(packed, toxic, fairness, groups=groups)
        scores = [r.mark for r in toxicity.scored(neutral, model, "mark").collect()]
        flagged.append(sum(s >= toxicity.THRESHOLD for s in scores))
        mean.append(sum(scores) / len(scores))
        rude_scores = [r.mark for r in toxicity.scored(learn.filter("toxic = 1"), model, "mark").collect()]
        assert sum(s >= toxicity.THRESHOLD for s in rude_scores) >= 0.85 * len(rude_scores)
    assert flagged[0] == 80 and flagged[1] == 0, (flagged, mean)


def test_training_learns_from_whole_texts(spark):
    draw = np.random.default_rng(4)
    filler = lambda n: " ".join("".join(draw.choice(list("abcdefgh"), 5)) for _ in range(n))
    ids = [i for i in range(500) if zlib.crc32(str(i).encode()) % 3 != 1]
    sample = lambda texts, label, module: training_sample(
        spark.createDataFrame(list(zip(ids, texts)), "doc_id bigint, text string"),
        spark.createDataFrame([(ids[i], i % 2) for i in range(len(texts))], f"doc_id bigint, {label} int"),
        label, module.features,
    )
    calm = [". ".join(filler(6) for _ in range(600)) for _ in range(40)]
    assert min(map(len, calm)) > 20_000
    packed, toxic = sample([f"{t}. You idiots and fools" * (i % 2) or t for i, t in enumerate(calm)], "toxic", toxicity)
    assert sum(toxic) == 20 and len(toxic) == 40
    assert toxicity.fit_features(packed, toxic).score("you idiots and fools") > toxicity.THRESHOLD
    assert list(map(sorted, toxicity._sentences(toxicity.features("One two. Two!  \n- \n\u00e9")))) == [
        ["one", "two"], ["two"], [], ["\u00e9"]
    ]

    junk = "$$$ ### %%% *** ### $$$ %%% ***"
    texts = [
        "\n".join([*(f"A plain sentence {filler(4)}." for _ in range(40)), *[junk] * 2 * (1 - i % 2)]) for i in range(40)
    ]
    packed, quality = sample(texts, "quality", line_crf)
    assert sum(quality) == 20 and sum(map(len, packed)) == 8 * 8 * (40 * 40 + 20 * 2)
    model = line_crf.fit_features(packed, quality)
    assert model.score(texts[1]) > line_crf.THRESHOLD > model.score(texts[0])
    assert model.score(junk) < line_crf.THRESHOLD < model.score("\n".join(texts[0].split("\n")[:4]))


def test_line_crf_blocks_hold_every_line_once():
    lengths = np.array([1, 40, 3, 3, 9, 1, 700])
    lines = np.concatenate([lines[live] for live, lines in line_crf._blocks(lengths)])
    assert sorted(lines) == list(range(lengths.sum()))


def test_token_files_know_special_tokens_like_the_library(spark, tmp_path):
    P, tokenizers = pytest.importorskip("public_tokenizers"), pytest.importorskip("tokenizers")
    model = P.path("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(model)
    mark = "<|endoftext|>"
    texts = [mark, f"a{mark}b", f"a  {mark} \n x", f"{mark}{mark}'s  ", f"word {mark}  two", f"<|{mark}", "<|endoftext"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found, start = token_files.query(spark, str(tmp_path)).orderBy("doc_id").collect(), 0
    for row, text in zip(found, texts, strict=True):
        ids = library.encode(text, add_special_tokens=False).ids + [token_files.END]
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        start += len(ids)


def test_training_takes_three_thousand_documents_of_a_class(spark):
    ids = [i for i in range(5200) if zlib.crc32(str(i).encode()) % 3 != 1]
    df = spark.createDataFrame([(i, f"text {i}", 1) for i in ids], "doc_id bigint, text string, quality int")
    assert len(ids) > 3000 and len(training_sample(df, df.drop("text"), "quality")[0]) == 3000
