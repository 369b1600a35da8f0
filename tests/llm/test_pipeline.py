from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import brute
import corpus_pipeline
from marketflow.llm.queries import QUERIES
from marketflow.llm.quality import quality

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def plain_rest(rows: list[tuple]) -> Counter:
    """What the stages after the classifier make of ``doc_id, text, source``: digests, counted."""
    seen, ids = [], sorted(rows, key=lambda r: r[0])
    roots = brute.components([brute.fingerprint(t) for _, t, _ in ids])
    seen = [r for n, r in enumerate(ids) if roots[n] == n]
    marks: set[bytes] = set()
    cut = []
    for doc, text, source in seen:
        raw = text.encode()
        mark = bytearray(len(raw))
        for at in range(len(raw) - 99):
            if raw[at : at + 100] in marks:
                mark[at : at + 100] = b"\1" * 100
            marks.add(raw[at : at + 100])
        cut.append((doc, bytes(b for b, m in zip(raw, mark) if not m).decode("utf-8", "ignore"), source))
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out: Counter = Counter()
    for (doc, size, _, _, taken), (_, text, _) in zip(brute.mixture([(d, s, t) for d, t, s in cut]), cut):
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")
        out[doc, len(ids), hashlib.sha256(ids.tobytes()).hexdigest()] += taken // size if size else 0
    return +out


def test_pipeline_matches_a_plain_version(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    good = {r["doc_id"] for r in quality(docs, spark.read.parquet(f"{DATA}/labels.parquet")).filter("predicted = 1").collect()}
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect() if r["doc_id"] in good]
    got = corpus_pipeline.run(spark, DATA).collect()
    # Texts without words may be taken any number of times: they add nothing to a mix.
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in got if r["n_tokens"]) == plain_rest(rows)
    assert 0 < len(good) < docs.count()


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_awkward_rows(spark, stage):
    text = "Some words that a document may hold, and then some more of them. " * 4
    rows = [(1, text, "en", "a", 9), (1, text, "en", "a", 9), (2, None, None, None, None), (None, text, "en", "b", 9), (3, "", "en", "b", 0), (4, "only", "en", "c", 4)]
    function = corpus_pipeline.STAGES[stage][1]
    out = function(spark, spark.createDataFrame(rows, SCHEMA), DATA)
    empty = function(spark, spark.createDataFrame([], SCHEMA), DATA)
    if stage < 4:
        assert out.columns == empty.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    assert out.count() > 0 and empty.count() == 0
    if stage == 1:
        assert sorted(r["doc_id"] for r in out.collect()) == [1, 2, 4]


@pytest.mark.parametrize("stage", range(5))
def test_stages_keep_columns_named_as_inside(spark, stage):
    names = "_score,_row,key,hash,size,fp,source_size,target,times,copies,threshold,bucket,block,n_tokens,_salt,of".split(",")
    text = "Some words that a document may hold, and then some more of them. " * 4
    rows = [(1, text, "en", "a", 9, *names), (2, "other words, unlike those", "en", "b", 9, *names), (3, None, None, None, None, *names)]
    docs = spark.createDataFrame(rows, SCHEMA + "".join(f", {n} string" for n in names))
    plain = corpus_pipeline.STAGES[stage][1](spark, docs.drop(*names), DATA)
    out = corpus_pipeline.STAGES[stage][1](spark, docs, DATA)
    shown = plain.columns
    assert Counter(tuple(r) for r in out.select(*shown).collect()) == Counter(tuple(r) for r in plain.collect())
    if stage < 4:
        assert out.columns == docs.columns
        assert all(tuple(r) == tuple(names) for r in out.select(*names).collect())


def test_near_duplicates_lose_no_other_text(spark):
    """Ids that repeat with other texts, rows without an id, and columns named as inside."""
    a, b, c = ("one two three four five six seven " * 9, "an unrelated text of its own, said once " * 8, "q w e r t y " * 9)
    rows = [(1, a), (2, a), (2, b), (None, c), (None, c), (None, a), (3, b), (None, None), (4, "")]
    docs = spark.createDataFrame([(d, t, "k", 1, "r") for d, t in rows], "doc_id long, text string, key string, fp int, _row string")
    out = corpus_pipeline.near_duplicate_stage(spark, docs, DATA)
    assert out.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == Counter([(1, a), (2, b), (None, c), (4, "")])


def test_everything_is_registered():
    names = set(entry.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("name", ["op3_chat_trees", "op4_hash_mix"])
def test_native_operators_run_no_python(spark, name):
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "mapPartitions"))
