"""The model of the secret scan: what is no key stays, keys that no rule names are found; long lists of hits take linear time."""

from __future__ import annotations

import base64
import random
import time

import pytest

from tests.llm import brute
from tests.llm.conftest import SF
from traitloom.llm import secrets
from traitloom.llm.common import table

ORDINARY = [
    "x" * 25, "ACGTACGTTAGCTAGGATCCATTAGCAT", "12345678901234567890", "0" * 20, "G" * 30, "image/jpeg/thumbnail/small/large",
    "getUserAccountInformation", "MAX_CONNECTION_POOL_SIZE_DEFAULT", "/usr/local/share/applications/default", "2022-11-09/123456-654321",
    "very-long-hyphenated-css-class-name", "Donaudampfschifffahrtsgesellschaft", "internationalization_localization",
    "java/util/concurrent/atomic/AtomicLong", "-" * 28, "=" * 20, "thisIsACamelCaseIdentifierName2", "20221109_12345678901234",
]


@pytest.fixture(scope="module")
def model(spark):
    return secrets.fit_on(table(spark, SF, "documents").select("doc_id", "text"))


def found(spark, model, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = secrets.scan(rows, model, column="spans").collect()
    return {r["doc_id"]: {s["kind"] for s in r["spans"]} for r in spans}


def test_ordinary_strings_are_no_keys(spark, model):
    kinds = found(spark, model, [f"see {x} there" for x in ORDINARY])
    assert {ORDINARY[i]: k for i, k in kinds.items() if k} == {}


def test_keys_that_no_rule_names_are_found(spark, model):
    rnd = random.Random(17)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = [base64.b64encode(rnd.randbytes(30)).decode() for _ in range(150)]
    keys += ["".join(rnd.choice(letters) for _ in range(rnd.randrange(20, 50))) for _ in range(150)]
    keys += ["".join(rnd.choice(letters[:26] + "234567") for _ in range(32)) for _ in range(150)]
    texts = [f"the value {key} was set" for key in keys]
    assert all(sum(counts[1:4]) == 0 for counts in brute.secrets(list(enumerate(texts))))
    kinds = found(spark, model, texts)
    assert sum(k == {"markov"} for k in kinds.values()) >= 0.98 * len(keys)


def test_held_out_identifiers_and_words(spark, model):
    """Error on strings the model has not seen: identifiers from other texts, random strings of other numbers."""
    other = table(spark, "/root/testdata/sf0.01", "documents").select("text")
    words = secrets.word_samples(other).filter("pmod(xxhash64(text), 7) = 3")
    plain = secrets.identifier_samples(words).filter("length(text) >= 20")
    keys = secrets.random_samples(spark, 2 * secrets.MAX_SAMPLES).limit(2 * secrets.MAX_SAMPLES).tail(2_000)
    rated = plain.select(secrets.score(plain["text"], model).alias("s"))
    assert rated.filter(f"s >= {secrets.THRESHOLD}").count() <= 0.02 * rated.count() and rated.count() > 100
    strings = spark.createDataFrame([(r["text"],) for r in keys], "text string")
    assert strings.filter(secrets.score(strings["text"], model) >= secrets.THRESHOLD).count() >= 0.98 * len(keys)


def test_spans_and_masks_over_blocks(spark, model):
    """More hits than a block, several kinds that overlap, characters of several bytes."""
    text = "password=abcdef1 " * 700 + "é token=x " * 300 + "AKIA" + "B" * 30 + " password=AKIA" + "0f" * 40 + " 日本 " + "secret=hunter22;" * 600
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    scanned = secrets.scan(docs, model, column="spans")
    spans = scanned.first()["spans"]
    base = [(s["kind"], s["start"], s["end"]) for s in spans if s["rank"] < len(secrets.RULES)]
    n_assign, n_access, n_hex, sha = brute.secrets([(1, text)])[0][1:]
    assert [sum(k == kind for k, *_ in base) for kind in ("assign", "access", "hex")] == [n_assign, n_access, n_hex]
    assert brute.sha(",".join(f"{k}:{a}:{b}" for k, a, b in base)) == sha and n_assign > 3 * secrets.BLOCK
    want, at = [], 0
    for s in spans:
        if s["start"] >= at:
            want += [text[at : s["start"]], "[SECRET]"]
        at = max(at, s["end"])
    assert secrets.redact(scanned, spans="spans").first()["text"] == "".join([*want, text[at:]])


def test_many_hits_take_linear_time(spark, model):
    docs = spark.createDataFrame([(1, "password=abcdef1 " * 40_000)], "doc_id long, text string")
    secrets.redact(secrets.scan(docs, model, column="s"), spans="s").write.format("noop").mode("overwrite").save()
    start = time.monotonic()
    masked = secrets.redact(secrets.scan(docs, model, column="s"), spans="s")
    assert masked.first()["text"] == "[SECRET] " * 40_000
    assert time.monotonic() - start < 30  # far below what a quadratic form takes


def test_nothing_found_leaves_the_text(spark, model):
    docs = spark.createDataFrame([(1, ""), (2, None), (3, "plain words")], "doc_id long, text string")
    masked = secrets.redact(secrets.scan(docs, model, column="s"), spans="s")
    assert sorted(map(tuple, masked.select("doc_id", "text").collect())) == [(1, ""), (2, None), (3, "plain words")]
