from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
from marketflow.llm.bpe import decode_ids, encode_and_decode, piece_table, split_words
from marketflow.llm.components import connected_components
from marketflow.llm.lm import fit, language_model_scores, score, token_blocks
from marketflow.llm.mixing import mix, mixing_plan, with_copies, with_hash
from marketflow.llm.labels import labelled_sample
from marketflow.llm.quality import fit_quality, quality
from marketflow.llm.repeats import removal_digests, sent_fragments, without_repeats
from marketflow.llm.simhash import fingerprint, link_runs, near_duplicates, similar_fingerprints
from marketflow.llm.suffix import induced
from marketflow.llm.toxicity import chosen_segments, fit_toxicity, toxicity

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, bucket string, hash int"


def table(spark, rows, parts: int = 3):
    """Documents with columns whose names operators use inside."""
    full = [(d, t, "en", s, len(t or ""), 0.5, "b", 1) for d, t, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def documents():
    """Copies, near copies, shared passages, nulls, blanks, repeated rows and a long text."""
    base = [prose(i, 60 + 5 * i) for i in range(12)]
    shared = prose(99, 70)
    rows = [(i, t, f"s{i % 4}") for i, t in enumerate(base)]
    rows += [(100 + i, base[0], "s1") for i in range(5)]
    rows += [(200 + i, base[1] + f" tail{i}", None) for i in range(6)]
    rows += [(300 + i, prose(300 + i, 30) + " " + shared + " " + prose(400 + i, 30), "s2") for i in range(6)]
    rows += [(400, None, "s3"), (401, "", "s3"), (402, " \t\n ", "s3"), (403, "one two", "s3"), (404, "One TWO", "zé")]
    rows += [(405, "ab " * 400, "s0"), (406, "Éa ß😀 " * 60, "s0"), (407, prose(5, 9000), "s1"), (None, base[2], "s1")]
    return rows


def rows_of(frame) -> list[tuple]:
    return sorted((tuple(r) for r in frame.collect()), key=lambda r: (r[0] is not None, r[0] or 0))


def test_fingerprints_and_groups_match_brute_force(spark, documents):
    got = rows_of(near_duplicates(table(spark, documents)))
    ordered = sorted(documents, key=lambda r: (r[0] is not None, r[0] or 0))
    fps = [brute.fingerprint(t) for _, t, _ in ordered]
    roots = brute.components(fps)
    ids = [d for d, _, _ in ordered]
    smallest = {r: min((ids[i] for i, x in enumerate(roots) if x == r and ids[i] is not None), default=None) for r in roots}
    assert got == [(d, f"{f:016x}", smallest[r]) for d, f, r in zip(ids, fps, roots)]


def test_repeated_rows_and_empty_tables_of_near_duplicates(spark):
    got = rows_of(near_duplicates(table(spark, [(1, "a b c", "s"), (1, "a b c", "s"), (None, "q r", "s")])))
    assert [r[0] for r in got] == [None, 1, 1] and [r[2] for r in got] == [None, 1, 1]
    assert near_duplicates(table(spark, [])).collect() == []


def test_links_are_whole_however_keys_are_cut(spark):
    rng = np.random.default_rng(2)
    center = rng.integers(0, 2**63, 3)
    near = [int(c) ^ (1 << int(a)) ^ (1 << int(b)) for c in center for a, b in rng.integers(0, 62, (60, 2))]
    far = rng.integers(0, 2**63, 200).tolist()
    fps = sorted({*near, *far})
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    whole = brute.components(fps)
    for chunk in (2048, 7):
        links = similar_fingerprints(frame, chunk)
        roots = {r["node"]: r["root"] for r in connected_components(links).collect()}
        assert [roots.get(f, f) for f in fps] == [fps[w] for w in whole]
        assert links.count() <= 15 * len(fps) * (len(fps) // chunk + 1)


def test_pivots_pass_every_true_link():
    fps = np.array([0, 0b1111, 0b11111, 1 << 60], dtype=np.uint64)
    labels = link_runs(fps, np.array([0]), np.array([4]))
    assert labels.tolist() == [0, 0, 0, 0]
    assert link_runs(np.array([0, 0b11111], dtype=np.uint64), np.array([0]), np.array([2])).tolist() == [0, 1]
    assert fingerprint(None) == fingerprint(b" \n") == 0


def test_components_of_a_chain_a_star_and_loops(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)]
    frame = spark.createDataFrame([*chain, *star, (7, 7), (500, 500), (None, 3)], "a long, b long")
    got = {r["node"]: r["root"] for r in connected_components(frame).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}


def test_mix_matches_brute_force(spark, documents):
    want = sorted(brute.mixture([(d, s, t) for d, t, s in documents]), key=lambda r: (r[0] is not None, r[0] or 0))
    got = rows_of(mix(table(spark, documents)))
    assert [(*r[:3], r[4]) for r in got] == [(*r[:3], r[4]) for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want])
    assert all(r[4] <= 3 * r[1] for r in got)


def test_mix_of_repeated_rows_empty_sources_and_nothing(spark):
    got = rows_of(mix(table(spark, [(1, "a b", "x"), (1, "a b", "x"), (2, None, "y")])))
    assert got[0] == got[1] and got[2][1:] == (0, 0, 0.0, 0)
    assert sum(r[4] for r in got) <= 12
    assert mix(table(spark, [])).collect() == []


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_language_model_matches_brute_force(spark, documents, tmp_path, monkeypatch, order):
    monkeypatch.setattr("marketflow.llm.lm.GRAMS_AT_ONCE", 500)
    monkeypatch.setattr("marketflow.llm.lm.TEXT_BYTES_PER_BUCKET", 2_000)
    want = sorted(brute.kneser_ney([(d, t) for d, t, _ in documents], order), key=lambda r: (r[0] is not None, r[0] or 0))
    got = rows_of(language_model_scores(table(spark, documents), str(tmp_path / "model"), order))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for n in (5, 6):
        assert [r[n] for r in got] == pytest.approx([r[n] for r in want], rel=1e-9)


def test_language_model_of_small_blocks_gives_the_same(spark, documents):
    texts = table(spark, documents).select("text")
    whole, cut = fit(texts, tokens_per_block=10**6), fit(texts, tokens_per_block=50)
    docs = table(spark, [(d, t, s) for d, t, s in documents if d is not None]).select("doc_id", "text")
    got = [sorted((r["doc_id"], r["score"]) for r in score(docs, m, n).collect()) for m, n in ((whole, 10**6), (cut, 50))]
    assert np.allclose([r[1] for r in got[0]], [r[1] for r in got[1]], rtol=1e-9)
    assert [r[0] for r in got[0]] == [r[0] for r in got[1]]


def test_language_model_adds_up_to_one_and_prefers_what_it_has_seen(spark):
    texts = spark.createDataFrame([(prose(3, 40),)] * 3 + [("b a c a b a",), ("a c",)], "text string")
    model = fit(texts)
    vocabulary = sorted({w for (t,) in texts.collect() for w in t.split()})

    def after(context: str) -> list[float]:
        """Probabilities of every known word, of the end and of one unknown word after a context."""
        blocks = token_blocks(iter(f"{context} {w}".encode() for w in [*vocabulary, "", "unseen"]), 10**6)
        (block,) = blocks
        logs = model.log_probabilities(block)[0]
        last = np.cumsum(block.sizes) - 2
        last[-2] += 1
        return list(10 ** logs[last])

    for context in ("b a", "a c", "unseen words", "c unseen", ""):
        assert sum(after(context)) == pytest.approx(1.0, rel=1e-9)
    assert after("b a")[vocabulary.index("c")] > after("c a")[vocabulary.index("c")]


def test_language_model_refuses_an_order_below_one(spark):
    with pytest.raises(ValueError, match="order"):
        fit(spark.createDataFrame([("a",)], "text string"), order=0)


def test_language_model_of_nothing_and_without_training(spark):
    assert language_model_scores(table(spark, [])).collect() == []
    held = next(d for d in range(100) if zlib.crc32(str(d).encode()) % 5 == 1)
    (row,) = language_model_scores(table(spark, [(held, "a b", "s")])).collect()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["score"]) == (3, 0, 0, 0.0)


def test_tokens_match_the_library(spark, documents):
    hard = [
        "Hello <|endoftext|>World ΌΣΑΣ don't 12 İ naïve x'S", "\x1c\x1d z​q   n　m", "<|startoftext|><|endoftext|>",
        "'re 've'Ll it'd", "Ⅻ ½ ²3 ١٢٣ 漢字かな한국어", "Å Å ſ ß ẞ ŉ ǰ", "👍🏽 ȩ́ ﬁ", "<|endoftext |> <|x|>", "a\x00b\x85c﻿", "Ǆ ǅ Σ σς",
    ]
    rows = [*documents, *((1000 + i, t, "s") for i, t in enumerate(hard))]
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = []
    for d, t, _ in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        text = tokenizer.decode(ids, skip_special_tokens=False)
        want.append((d, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    want.sort(key=lambda r: (r[0] is not None, r[0] or 0))
    assert rows_of(encode_and_decode(table(spark, rows), TOKENIZER)) == want
    assert rows_of(encode_and_decode(table(spark, rows), TOKENIZER, words_per_block=50, buckets=3)) == want
    assert encode_and_decode(table(spark, []), TOKENIZER).collect() == []
    assert split_words("a <|endoftext|>") == ["a", "<|endoftext|>"]


def test_texts_are_decoded_through_the_join_with_pieces(spark, documents, monkeypatch):
    plain = rows_of(encode_and_decode(table(spark, documents), TOKENIZER))
    pieces = piece_table(table(spark, []), TOKENIZER).withColumn("piece", F.concat("piece", F.lit("#")))
    monkeypatch.setattr("marketflow.llm.bpe.piece_table", lambda *_: pieces)
    marked = rows_of(encode_and_decode(table(spark, documents), TOKENIZER, words_per_block=80, buckets=3))
    assert [r[:3] for r in marked] == [r[:3] for r in plain]
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = Counter()
    for doc, text, _ in documents:
        tokens = tokenizer.encode(text or "", add_special_tokens=False).tokens
        want[doc, hashlib.sha256(" ".join(t + "#" for t in tokens).encode()).hexdigest()] += 1
    assert Counter((r[0], r[3]) for r in marked) == want


def test_decoding_joins_pieces_by_position(spark):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    ids = [tokenizer.encode(t, add_special_tokens=False).ids for t in ("the the cat", "x y")]
    frame = spark.createDataFrame([(1, ids[0]), (2, ids[1]), (3, []), (4, None)], "n int, ids array<int>")
    got = {r["n"]: r["decoded"] for r in decode_ids(frame, TOKENIZER).collect()}
    assert got == {1: tokenizer.decode(ids[0]), 2: tokenizer.decode(ids[1]), 3: "", 4: None}


def test_removed_repeats_match_brute_force(spark, documents):
    want = sorted(brute.removals([(d, t) for d, t, _ in documents]), key=lambda r: (r[0] is not None, r[0] or 0))
    assert rows_of(removal_digests(table(spark, documents))) == want
    # Small slices and a queue that keeps almost nothing in memory: sorting goes over disk.
    assert rows_of(removal_digests(table(spark, documents), slice_bytes=500, memory_rows=64)) == want
    assert removal_digests(table(spark, [])).collect() == []


def test_repeated_rows_lose_the_same_and_texts_of_one_id_differ(spark):
    text = prose(1, 60)
    got = rows_of(removal_digests(table(spark, [(1, text, "s"), (1, text, "s"), (2, text + " more", "s"), (2, "x", "s")])))
    assert [r[2] for r in got[:2]] == [0, 0]
    assert sorted(r[2] for r in got[2:]) == [0, len(text)]
    rows = table(spark, [(1, "é" * 120, "s"), (2, "é" * 120 + "b", "s"), (3, None, "s")])
    rows = rows.selectExpr("*", "'k' AS key", "'h' AS text_hash", "1 AS _key", "2 AS start")
    cut = without_repeats(rows).orderBy("doc_id").collect()
    assert {(r["key"], r["text_hash"], r["_key"], r["start"]) for r in cut} == {("k", "h", 1, 2)}
    # In a run of one letter every string but the first two repeats one before: their first bytes stay.
    assert [r["text"] for r in cut] == ["é", "b", None]
    assert cut[0]["score"] == 0.5


def test_no_frequent_line_is_one_task(spark, tmp_path):
    line = "-- this line of fifty-three bytes is in all documents --"
    rows = [(i, prose(i, 30) + " " + prose(900 + i % 100, 20) + line + prose(i, 30), "s") for i in range(240)]
    rows += [(900 + i, t, "s") for i, (_, t, _) in enumerate(rows[:9])]
    docs = table(spark, rows)
    want = sorted(brute.removals([(d, t) for d, t, _ in rows]))
    assert sum(r[2] > 0 for r in want) >= 140
    for slice_bytes in (4 << 20, 2000):
        assert rows_of(removal_digests(docs, slice_bytes=slice_bytes)) == want
    packed = sent_fragments(docs.selectExpr("doc_id AS key", "xxhash64(text) AS text_hash", "text"), str(tmp_path), 4, 100, 2000)
    sent: dict[int, set] = {}
    for data in (r["data"] for r in packed.filter("bucket >= 0").collect()):
        text, at = zstandard.decompress(data[5]), 0
        for h, n in zip(np.frombuffer(data[0], np.uint64).tolist(), np.frombuffer(data[4], np.uint16).tolist()):
            sent.setdefault(h, set()).add(text[at : at + n + 99])
            at += n + 99
    # 2,000 bytes hold 11 fragments of 168 bytes at most; the line's anchors have 240 and more.
    assert max(map(len, sent.values())) <= 11


@pytest.mark.parametrize("rows", [3, 40, 10_000])
def test_suffix_order_and_common_prefixes(rows):
    rng = np.random.default_rng(5)
    for trial in range(60):
        text = rng.integers(1, rng.integers(2, 6), int(rng.integers(1, 90)))
        text = np.tile(text[:9], 8)[: len(text)] if trial % 3 == 0 else text
        chunks = list(induced(text, 12, rows))
        places, prefixes = (np.concatenate(c).tolist() for c in zip(*chunks))
        assert sorted(places) == list(range(len(text)))
        for before, here, prefix in zip(places, places[1:], prefixes[1:]):
            a, b = text[before : before + 12].tolist(), text[here : here + 12].tolist()
            assert a >= b
            assert prefix == next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def labelled(spark, bad: list[str], good: list[str], column: str):
    texts = [(i, t, "s") for i, t in enumerate([*bad, *good])]
    labels = spark.createDataFrame(
        [(i, int(i >= len(bad))) for i in range(len(texts))] + [(None, 1), (10_000, None)], f"doc_id long, {column} int"
    )
    extra = [(5000, None, "s"), (5001, "", "s"), (5001, "", "s"), (None, good[0], "s")]
    return table(spark, texts + extra), labels, len(bad)


def check_scores(frame, column_of_one: int, total: int) -> float:
    rows = frame.collect()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 5 == 0) for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (5000, 5001)}) == 1
    held = [r for r in rows if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < total]
    return sum(r["predicted"] == int(r["doc_id"] >= column_of_one) for r in held) / len(held)


def test_quality_of_held_out_documents(spark):
    bad = [prose(i, 80).upper().replace(" ", "!! ") for i in range(60)] + [("w" + prose(i, 1) + " ") * 60 for i in range(60)]
    docs, labels, ones = labelled(spark, bad, [prose(1000 + i, 80) for i in range(240)], "quality")
    assert check_scores(quality(docs, labels), ones, 360) >= 0.95


AWKWARD = ["", None, " \t\n", "a", "a a a  a", "É ß 漢字\x0bx", "word " * 70 + prose(5, 40)]


def test_quality_matches_a_plain_forward_pass(spark):
    docs, labels, _ = labelled(spark, [prose(i, 60).upper() for i in range(40)], [prose(900 + i, 60) for i in range(40)], "quality")
    model = fit_quality(docs, labels)
    texts = [*AWKWARD, prose(1, 80).upper(), prose(2, 60_000)]
    want = [brute.quality_score(model, t) for t in texts]
    assert model.scores([(t or "").encode() for t in texts]) == pytest.approx(want, rel=1e-6)
    assert len(texts[-1]) > 1 << 18 and len(set(want)) >= 6


def test_toxicity_matches_windows_compressed_one_by_one(spark):
    toxic = [prose(i, 60) + " zzvorkel xxqumbly " + prose(500 + i, 20) for i in range(60)]
    docs, labels, _ = labelled(spark, [prose(900 + i, 80) for i in range(120)], toxic, "toxic")
    model = fit_toxicity(docs, labels)
    texts = [*AWKWARD, toxic[0], toxic[1].upper(), prose(2, 100_000)]
    want = [brute.toxicity_score(model, t) for t in texts]
    assert model.scores([(t or "").encode() for t in texts]) == pytest.approx(want, rel=1e-9)
    assert len(texts[-1]) > 20_000 * 24


def test_labelled_sample_takes_one_text_of_an_id_whatever_the_layout(spark):
    ids = [d for d in range(40) if zlib.crc32(str(d).encode()) % 5]
    labels = spark.createDataFrame([(d, d % 2) for d in ids], "doc_id long, quality int")
    rows = [(d, prose(d + n, 5), "s") for d in ids for n in range(6)] + [(d, None, "s") for d in ids[:3]]
    samples = []
    for order, parts in ((rows, 1), (rows[::-1], 7)):
        sample, sizes = labelled_sample(table(spark, order, parts), labels, "quality", 100)
        samples.append(sorted(tuple(r) for r in sample.collect()))
    assert samples[0] == samples[1] and [s[0] for s in samples[0]] == ids and sum(sizes.values()) == len(ids)


def test_quality_without_labels_or_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality(table(spark, [(1, "a", "s"), (2, None, "s")]), empty).collect()} == {0.5}
    assert quality(table(spark, []), empty).collect() == []


def test_toxicity_of_held_out_documents(spark):
    def toxic(seed: int) -> str:
        found = prose(seed, 100).split()
        for n, word in enumerate(("zzvorkel", "xxqumbly", "yyplonk")):
            found[10 + 30 * n] = word
        return " ".join(found)

    docs, labels, ones = labelled(spark, [prose(1000 + i, 100) for i in range(300)], [toxic(i) for i in range(120)], "toxic")
    assert check_scores(toxicity(docs, labels), ones, 420) >= 0.95


def test_toxicity_without_labels_or_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity(table(spark, [(1, "a", "s"), (2, None, "s")]), empty).collect()} == {0.5}
    assert toxicity(table(spark, []), empty).collect() == []


def test_toxic_and_ordinary_dictionaries_are_both_trained(spark):
    rng = random.Random(8)
    bad = [prose(i, 100) + " zzvorkel" + prose(2000 + i, 3) for i in range(300)]
    good = [" ".join(f"mild{rng.randint(0, 20)}" for _ in range(100)) for _ in range(300)]
    texts = [(i, t, "s") for i, t in enumerate([*bad, *good])]
    labels = spark.createDataFrame([(i, int(i < 300)) for i in range(600)], "doc_id long, toxic int")
    (ordinary, toxic), (ordinary_marks, toxic_marks) = fit_toxicity(table(spark, texts), labels).pairs
    assert b"zzvorkel" in toxic and b"zzvorkel" not in ordinary
    assert len(toxic) == len(ordinary) and len(toxic_marks) == len(ordinary_marks)
    assert b"zzvorkel" in toxic_marks and b"mild" not in toxic_marks[-len(b" mild1") :]
    assert ordinary_marks != toxic_marks and b"mild" in ordinary_marks[-12:]


def test_parts_of_one_word_take_one_place():
    ranked = [b" abcdefgh"[:n] for n in range(9, 4, -1)] + [b" second", b" third"]
    assert chosen_segments(ranked) == [b" abcdefgh", b" second", b" third"]


def test_mix_of_rows_that_share_an_id_or_are_repeated(spark):
    """Sources of rows without an id, of one id, and of one row repeated come near their targets all the same."""
    rows = [(None, prose(n, 50), "a") for n in range(300)] + [(7, prose(n, 50), "b") for n in range(300)]
    rows += [(8, prose(1, 50), "c")] * 600
    for parts in (1, 5):
        got = [tuple(r) for r in mix(table(spark, rows, parts)).collect()]
        assert Counter(got) == Counter(brute.mixture([(d, s, t) for d, t, s in rows]))
        for size in {r[2:4] for r in got}:
            taken = sum(r[4] for r in got if r[2:4] == size)
            assert abs(taken - size[1]) <= 50


def test_mix_of_more_sources_than_are_broadcast(spark):
    """Thresholds meet documents by source and part of it; a source that holds most is no single task."""
    rows = [(n, prose(n, 5 + n % 9), f"s{n % 90}" if n % 3 else "hot") for n in range(900)]
    want = Counter(brute.mixture([(d, s, t) for d, t, s in rows]))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = table(spark, rows)
        assert Counter(tuple(r) for r in mix(docs).collect()) == want
        sized = with_hash(docs.select("doc_id", "source", "text"))
        joined = with_copies(sized, mixing_plan(sized))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan.split("LeftOuter")[-2].rsplit("\n", 1)[-1] and "_salt" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
