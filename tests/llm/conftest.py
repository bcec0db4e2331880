import os
import random

import pytest

SF = "/root/testdata/sf0.001"

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def awkward_documents():
    """Nulls, blanks, long texts, ties, exact and near copies, passages shared by several texts, secrets at odd places."""
    rnd = random.Random(3)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "pu", "ró", "şa") for b in ("ra", "st", "vel", "N", "9")]

    def prose(n):
        return " ".join(rnd.choice(words) for _ in range(n))

    passage, base = prose(60), prose(150)
    near = base.split()
    near[75] = "other"
    texts = [
        None,
        "",
        " \t\n\r ",
        "one",
        "ONE",
        "a b c d",
        "a  b\tc\nd",
        base,
        base.upper(),
        " ".join(near),
        base,
        prose(20) + " " + passage + " " + prose(10),
        passage,
        passage + " " + passage,
        prose(3) + " " + passage,
        prose(20_000),
        "x" * 5_000 + " password=abcdef",
        "PassWord : 'hunter22' token=abc api_key=abc;apikey=\"zz/zz+zz==\"",
        "AKIA" + "A1" * 8 + " AKIASHORT " + "0f" * 12 + "g" + "ab1" * 30,
        "token=secret=password=abcdef ſecret=abcdef",
        "日本語 テキスト 👩‍👩‍👧 naïve ﬁ " + "é" * 40 + "▁   　 x",
        "How many legs has the very old spider that lives in the attic of my house? Eight legs",
        "yes",
        "tail\u0000zero\u000bvertical \u0085 next",
    ]
    rows = [(i + 1, t, "en", "s" if i % 3 else "hot", len(t) if t is not None else None) for i, t in enumerate(texts)]
    return rows + [(100 + i, base, "en", "hot", len(base)) for i in range(30)]


ITEMS = [
    (1, "how MANY legs has the very old spider, that lives in the attic of my house"),
    (2, "Eight legs"),
    (3, ""),
    (4, None),
    (10, "eight legs"),
]

PAGE = "<html><head><title>T</title></head><body><nav><a href=x>Home</a></nav><article><h1>A head</h1><p>%s</p></article></body></html>"


@pytest.fixture(scope="session")
def awkward(spark, tmp_path_factory):
    """A folder with the tables the queries read, small and full of special cases, with columns of clashing names."""
    folder = str(tmp_path_factory.mktemp("awkward"))

    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(os.path.join(folder, f"{name}.parquet"))

    clash = ", score double, ids string, spans string, items string, start int, `a.b` string"
    put("documents", [(*r, 0.5, "i", "s", "t", 1, "dot") for r in awkward_documents()], DOCS + clash)
    put("benchmark", ITEMS, "item_id long, text string")
    put("labels", [(r[0], i % 2, 0) for i, r in enumerate(awkward_documents())], "doc_id long, quality int, toxic int")
    body = PAGE % ("Real text &amp; more of it, long enough to be the main matter. " * 5)
    pages = [(1, "u1", None), (2, "u2", ""), (3, None, body), (4, "u\r\n4", body), (5, "u5", "<p>broken <b>mark"), (6, "u6", body)]
    put("pages", pages, "page_id long, url string, html string")
    vectors = [(i, [float((i * j) % 7 - 3) for j in range(1, 9)]) for i in range(1, 120)]
    vectors += [(200, None), (250, [0.0] * 8), (300, [None] * 8), (350, [float("nan")] * 8), (400, [1e-200] * 8), (401, [1e200] * 8)]
    put("embeddings", vectors, "vec_id long, embedding array<double>")
    return folder


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    """The same tables without rows."""
    folder = str(tmp_path_factory.mktemp("empty"))
    schemas = {
        "documents": DOCS,
        "benchmark": "item_id long, text string",
        "labels": "doc_id long, quality int, toxic int",
        "pages": "page_id long, url string, html string",
        "embeddings": "vec_id long, embedding array<float>",
        "conversations": "conv_id long, turn long, role string, text string",
    }
    for name, schema in schemas.items():
        spark.createDataFrame([], schema).write.parquet(os.path.join(folder, f"{name}.parquet"))
    return folder
