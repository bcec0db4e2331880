"""Every dealt query against brute force, on the awkward tables, on the small driver tables, and on empty ones."""

from __future__ import annotations

import numpy as np
import pytest

from corpus_pipeline import COLUMNS, STAGES, run
from tests.llm import brute
from tests.llm.conftest import SF
from traitloom.llm import decontaminate, order, quality, secrets
from traitloom.llm.common import table
from traitloom.llm.queries import QUERIES, piece_model


def folder_of(name, awkward):
    return awkward if name == "awkward" else SF


def collected(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def texts(spark, folder, name="documents", columns=("doc_id", "text")):
    return [tuple(r) for r in table(spark, folder, name).select(*columns).collect()]


both = pytest.mark.parametrize("name", ["awkward", "small"])


@both
def test_decontamination(spark, awkward, name):
    folder = folder_of(name, awkward)
    got = QUERIES["op1_decontamination"](spark, folder)
    want = brute.decontamination(texts(spark, folder), texts(spark, folder, "benchmark", ("item_id", "text")))
    assert collected(got, ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]) == sorted(want, key=str)
    assert any(row[-1] for row in want)


def test_decontamination_in_several_blocks_gives_the_same(spark, awkward):
    docs, items = table(spark, awkward, "documents").select("doc_id", "text"), table(spark, awkward, "benchmark")
    whole, parts = decontaminate.scan(docs, items), decontaminate.scan(docs, items, max_pattern_chars=20)
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))


def test_offsets_name_the_place_in_the_original_text(spark, awkward):
    docs = table(spark, awkward, "documents").select("doc_id", "text").filter("text like 'How many%'")
    row = decontaminate.scan(docs, table(spark, awkward, "benchmark")).first()
    places = [row["text"][s["start"] : s["end"]] for s in row["spans"]]
    assert " ".join(places).replace("? ", " ") == row["text"].replace("? ", " ")


@both
def test_secrets(spark, awkward, name):
    folder = folder_of(name, awkward)
    got = QUERIES["op5_secret_scan"](spark, folder)
    want = brute.secrets(texts(spark, folder))
    assert collected(got, ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256"]) == sorted(want, key=str)


def test_redaction_removes_every_span(spark, awkward):
    docs = table(spark, awkward, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.fit_on(docs), column="spans")
    masked = secrets.redact(found, spans="spans").select("doc_id", "text")
    rows = [tuple(r) for r in masked.collect()]
    assert sum(sum(r[1:4]) for r in brute.secrets(rows)) == 0


@both
def test_sentencepiece(spark, awkward, name):
    folder = folder_of(name, awkward)
    got = QUERIES["op6_sentencepiece"](spark, folder)
    want = brute.sentencepiece_rows(texts(spark, folder), piece_model())
    assert collected(got, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]) == sorted(want, key=str)


@both
def test_substring_dedup(spark, awkward, name):
    folder = folder_of(name, awkward)
    got = QUERIES["op8_substring_dedup"](spark, folder)
    want = brute.repeats(texts(spark, folder))
    assert collected(got, ["doc_id", "n_words", "n_removed", "kept_sha256"]) == sorted(want, key=str)


@both
def test_jaccard_groups(spark, awkward, name):
    folder = folder_of(name, awkward)
    got = QUERIES["op9_ngram_jaccard_join"](spark, folder)
    want = brute.near_groups(texts(spark, folder))
    assert collected(got, ["doc_id", "n_shingles", "component_id"]) == sorted(want, key=str)
    assert any(doc_id != component for doc_id, _, component in want)


@both
def test_revisits(spark, awkward, name):
    folder = folder_of(name, awkward)
    got = QUERIES["op10_warc_revisits"](spark, folder)
    want = brute.revisits(texts(spark, folder, "pages", ("page_id", "html")))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert collected(got, columns) == sorted(want, key=str)


@both
def test_nearest_neighbours(spark, awkward, name):
    folder = folder_of(name, awkward)
    rows = QUERIES["op4_nearest_neighbours"](spark, folder).collect()
    want = brute.nearest(texts(spark, folder, "embeddings", ("vec_id", "embedding")))
    got = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
    assert got.keys() == want.keys()
    near = found = 0
    for query, best in want.items():
        assert len(got[query]) == len(best)
        near += sum(c <= best[-1][0] + 1e-12 for c, _ in got[query])
        found += len(best)
    assert near / found >= 0.9


def test_html_extraction(spark, awkward):
    rows = {r["page_id"]: r for r in QUERIES["op2_html_extraction"](spark, awkward).collect()}
    assert (rows[1]["text"], rows[1]["n_chars"], rows[2]["text"]) == ("", 0, "")
    main = "A head " + " ".join(["Real text & more of it, long enough to be the main matter."] * 5)
    assert rows[3]["text"] == rows[4]["text"] == main and rows[3]["n_chars"] == len(main)
    assert rows[5]["text"] == "broken mark"


def test_quality_scores_the_held_out_rows_well(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op7_quality_classifier"](spark, folder).collect()
    labels = {r["doc_id"]: r["quality"] for r in table(spark, folder, "labels").collect()}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    assert all(r["held_out"] == brute.held_out(r["doc_id"]) for r in rows)
    held = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(a == b for a, b in held) / len(held) >= 0.85


def test_quality_does_not_learn_from_held_out_labels(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text", "n_chars")
    labels = table(spark, SF, "labels")
    rows = quality.training_rows(docs, labels).select("doc_id").collect()
    assert rows and not any(brute.held_out(r["doc_id"]) for r in rows)


def test_quality_awkward(spark, awkward):
    rows = QUERIES["op7_quality_classifier"](spark, awkward).collect()
    assert len(rows) == table(spark, awkward, "documents").count()
    assert all(r["score"] is not None and 0 <= r["score"] <= 1 for r in rows)


@both
def test_training_order(spark, awkward, name):
    """Slots are a bijection, pieces of a text put together are the text, and a shard can be read from any slot."""
    folder = folder_of(name, awkward)
    rows = QUERIES["op3_training_order"](spark, folder).collect()
    assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    total = {}
    for r in rows:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["n_tokens"]
    for doc_id, text in texts(spark, folder):
        assert total.get(doc_id, 0) == len((text or "").encode())
    assert len({(r["doc_id"], r["part"]) for r in rows}) == len(rows)


@pytest.mark.parametrize("size", [1, 2, 3, 17, 1000, 4097])
def test_permutation_is_a_bijection(size):
    assert sorted(order.Permutation(size, 5).slots(np.arange(size)).tolist()) == list(range(size))


@pytest.mark.parametrize("query", sorted(QUERIES))
def test_empty_tables(spark, empty, query):
    assert QUERIES[query](spark, empty).count() == 0


def test_pipeline_stages_against_brute_force(spark):
    """The decision of each stage, judged on the rows its predecessor kept."""
    docs = table(spark, SF, "documents")
    items = texts(spark, SF, "benchmark", ("item_id", "text"))
    kept = {}
    for name, stage in STAGES:
        out = stage(spark, docs, SF)
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        after = {r["doc_id"]: r for r in out.collect()}
        kept[name] = after
        if name == "ngram_jaccard_join":
            assert set(after) == {d for d, _, c in brute.near_groups(list(before.items())) if d == c}
        elif name == "benchmark_decontamination":
            assert set(after) == {r[0] for r in brute.decontamination(list(before.items()), items) if not r[-1]}
        elif name == "secret_scan":
            assert set(after) == set(before)
            assert sum(sum(r[1:4]) for r in brute.secrets([(d, r["text"]) for d, r in after.items()])) == 0
        elif name == "sentencepiece_encoding":
            want = {r[0]: r[1:3] for r in brute.sentencepiece_rows(list(before.items()), piece_model())}
            got = {d: (len(r["ids"]), brute.sha(",".join(map(str, r["ids"])))) for d, r in after.items()}
            assert got == want
        else:
            assert set(after) < set(before)
        if name != STAGES[-1][0]:
            assert tuple(out.columns) == COLUMNS
        docs = out


def test_pipeline_on_awkward_and_empty_tables(spark, awkward, empty):
    assert run(spark, empty).count() == 0
    assert set(COLUMNS) <= set(run(spark, awkward).columns)
