"""Language filter: false positives, held-out accuracy, awkward rows."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from traitloom.llm import language
from traitloom.llm.common import table
from traitloom.llm.queries import QUERIES


def brute_grams(text):
    """N-grams of each word with its ends as a mark, by plain slicing."""
    word, out = [], []
    for char in (text or "") + " ":
        if char.isalpha():
            word.append(char.lower()[0])
            continue
        if word:
            marked = ["", *word, ""]
            for size in language.SIZES:
                out += [tuple(marked[i : i + size]) for i in range(len(marked) - size + 1)]
        word = []
    return out


@pytest.mark.parametrize("step", [7, 1 << 17])
def test_grams_are_those_of_words_in_any_step(monkeypatch, step):
    monkeypatch.setattr(language, "_STEP", step)
    texts = ["One two-THREE", None, "", "  ", "İstanbul Straße 日本語", "x" * 50, "a b", "!?"]
    lettered, pieces = language.grams_of(texts)
    found = [[] for _ in texts]
    for owner, grams in pieces:
        for o, g in zip(owner, grams):
            found[o].append(int(g))
    assert lettered.tolist() == [True, False, False, False, True, True, True, False]
    wanted = [brute_grams(t) for t in texts]
    assert [len(f) for f in found] == [len(w) for w in wanted]
    # Equal n-grams have equal hashes and different ones different hashes, across all texts.
    names = {}
    for gram, value in zip(sorted(set(sum(wanted, []))), range(10**9)):
        names[gram] = value
    assert len(set(sum(found, []))) == len(names)
    for f, w in zip(found, wanted):
        assert sorted(np.unique(f, return_counts=True)[1]) == sorted(np.unique([names[g] for g in w], return_counts=True)[1])


def test_lookup_returns_every_language_and_few_others():
    rnd = np.random.default_rng(5)
    lists = {f"l{i}": rnd.integers(0, 1 << 64, 3_000, dtype=np.uint64) for i in range(11)}
    lists["l0"] = np.concatenate([lists["l0"], lists["l7"][:500]])
    made = language.build(lists)
    for number, name in enumerate(made.languages):
        bits = np.unpackbits(made.lookup(lists[name]), axis=1, count=11)
        assert bits[:, number].all()
    strange = np.unpackbits(made.lookup(rnd.integers(0, 1 << 64, 200_000, dtype=np.uint64)), axis=1, count=11).mean(axis=0)
    assert np.abs(strange - made.noise).max() < 0.003 and made.noise.max() < 0.015


def test_corrected_counts_are_near_the_true_ones():
    rnd = np.random.default_rng(6)
    texts = [" ".join("".join(rnd.choice(list("abcdefgh"), 6)) for _ in range(4_000)) for _ in range(2)]
    grams = [np.unique(np.concatenate([g for _, g in language.grams_of([t])[1]])) for t in texts]
    made = language.build({"a": grams[0][:300], "b": grams[0], "c": grams[1]}, false_positives=0.3)
    _, total, counts = made.counts([texts[0]])
    occurring = np.concatenate([g for _, g in language.grams_of([texts[0]])[1]])
    true = [np.isin(occurring, g).sum() for g in (grams[0][:300], grams[0], grams[1])]
    assert total[0] == len(occurring)
    assert np.abs(counts[0] - true).max() < 0.03 * total[0]


def test_held_out_accuracy_and_contract(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op11_language_id"](spark, folder).collect()
    known = {r["doc_id"]: r["lang"] for r in table(spark, folder, "documents").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(known)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    held = [r["lang_pred"] == known[r["doc_id"]] for r in rows if r["held_out"]]
    assert sum(held) / len(held) >= 0.95


def test_nothing_is_learnt_from_held_out_or_unlabelled_rows(spark):
    rows = [(i, "de" if i % 2 else None, f"text {i} wort") for i in range(40)] + [(None, "de", "no id"), (3, "de", None)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    used = {r["text"] for r in language.training_texts(docs, "text", "lang", "doc_id", 100).collect()}
    assert used == {t for i, lang, t in rows if t and i is not None and lang and zlib.crc32(str(i).encode()) % 5}


def test_copies_count_once_and_the_bound_holds(spark):
    rows = [(i, "de", "kopie") for i in range(3_000)] + [(5_000 + i, "de", f"wort nummer {i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(7)
    texts = [r["text"] for r in language.training_texts(docs, "text", "lang", "doc_id", 50).collect()]
    assert len(texts) == len(set(texts)) == 50


def test_awkward_rows(spark, awkward):
    rows = {r["doc_id"]: r for r in QUERIES["op11_language_id"](spark, awkward).collect()}
    texts = {r["doc_id"]: r["text"] for r in table(spark, awkward, "documents").collect()}
    assert rows.keys() == texts.keys()
    for doc_id, text in texts.items():
        expected = "en" if any(c.isalpha() for c in text or "") else "und"
        assert (rows[doc_id]["lang_pred"], rows[doc_id]["score"] > 0 or expected == "und") == (expected, True)


def test_without_known_languages_everything_is_unknown(spark):
    docs = spark.createDataFrame([(1, None, "some text"), (2, None, None), (None, None, "x")], "doc_id long, lang string, text string")
    found = language.predict(docs, language.train(docs), score="doc_id_score").collect()
    assert [(r["lang_pred"], r["doc_id_score"]) for r in found] == [("und", 0.0)] * 3


def test_repeated_rows_and_clashing_columns(spark):
    rows = [(1, "de", "ein wort", "x", 5)] * 4 + [(2, "fr", "une chose", "y", 6)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string, SCORE string, hash int").repartition(3)
    found = language.predict(docs, language.train(docs))
    assert found.columns == ["doc_id", "lang", "text", "hash", "lang_pred", "score"]
    assert sorted((r["doc_id"], r["lang_pred"]) for r in found.collect()) == [(1, "de")] * 4 + [(2, "fr")] * 3
