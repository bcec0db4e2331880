"""One query per operator over its whole table, and the pipeline; SQL where DuckDB can give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traitloom.llm import decontaminate, html_text, jaccard, language, neighbours, order, pieces, prefix_trie, quality, repeats, secrets, warc, whitening
from traitloom.llm.common import table
from traitloom.sources.scratch import scratch_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def piece_model() -> bytes:
    """Content of the public vocabulary file the queries use; its place is not written down here."""
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return file.read()


def _is(value: str):
    return lambda x: x == value


@query("op5_secret_scan")
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.fit_on(docs), column="spans")
    base = F.filter("spans", lambda s: s["rank"] < len(secrets.RULES))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, _is(kind))).cast("long").alias(f"n_{kind}") for kind, *_ in secrets.RULES]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"),
    )


@query("op10_warc_revisits")
def op10_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.deduplicate(table(spark, sf_dir, "pages"), scratch_folder(spark, "warc"))
    return read.select(
        F.col("record_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


@query("op6_sentencepiece")
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode(docs, piece_model()).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(pieces.ids_text(), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


@query(
    "op8_substring_dedup",
    """
    WITH words AS (
        SELECT doc_id, [x FOR x IN string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w
        FROM documents
    ), windows AS (
        SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k
        FROM words, unnest(range(1, len(w) - 11)) AS t(i) WHERE len(w) >= 13
    ), least AS (
        SELECT k, min(doc_id) AS m FROM windows GROUP BY k
    ), hits AS (
        SELECT doc_id, list(i) AS starts FROM windows JOIN least USING (k) WHERE m < doc_id GROUP BY doc_id
    ), covered AS (
        SELECT doc_id, list_distinct(flatten([range(i, i + 13) FOR i IN starts])) AS gone FROM hits
    ), kept AS (
        SELECT doc_id, w, coalesce(gone, []) AS gone FROM words LEFT JOIN covered USING (doc_id)
    ), flagged AS (
        SELECT doc_id, i, w[i] AS word FROM kept, unnest(range(1, len(w) + 1)) AS t(i)
    ), lost AS (
        SELECT doc_id, unnest(gone) AS i FROM covered
    ), rest AS (
        SELECT f.doc_id, string_agg(f.word, ' ' ORDER BY f.i) AS kept
        FROM flagged f ANTI JOIN lost l ON f.doc_id = l.doc_id AND f.i = l.i GROUP BY f.doc_id
    )
    SELECT k.doc_id, len(k.w)::BIGINT AS n_words, len(k.gone)::BIGINT AS n_removed,
           sha256(coalesce(r.kept, '')) AS kept_sha256
    FROM kept k LEFT JOIN rest r USING (doc_id)
    """,
)
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query(
    "op1_decontamination",
    r"""
    WITH d AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents
    ), b AS (
        SELECT item_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark
    ), patterns AS (
        SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS k
        FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0
    ), lengths AS (
        SELECT DISTINCT n FROM patterns
    ), places AS (
        SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS k
        FROM d, lengths, unnest(range(1, len(w) - n + 2)) AS t(i) WHERE len(w) >= n
    ), hits AS (
        SELECT p.doc_id, p.i, p.n, q.item_id FROM places p JOIN patterns q ON p.k = q.k AND p.n = q.n
    ), words AS (
        SELECT doc_id, count(DISTINCT j) AS n_hit FROM hits, unnest(range(i, i + n)) AS t(j) GROUP BY doc_id
    ), items AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
    )
    SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
)
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.scan(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(decontaminate.items_text(), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op7_quality_classifier")
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    model = quality.train(docs, table(spark, sf_dir, "labels"), metadata=["n_chars"])
    return quality.score(docs, model, metadata=["n_chars"]).select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.ACCEPT).cast("int").alias("predicted"),
    )


@query(
    "op9_ngram_jaccard_join",
    r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, [x FOR x IN string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x20\x09-\x0D]+') IF x <> ''] AS w
        FROM documents
    ), shingles AS (
        SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s, least(len(w), 5) AS k
        FROM words, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0
    ), sizes AS (
        SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
    ), links AS (
        SELECT a.doc_id AS a, b.doc_id AS b
        FROM shingles a JOIN shingles b ON a.s = b.s AND a.k = b.k AND a.doc_id <> b.doc_id
        JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
        GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
    ), reach(doc_id, other) AS (
        SELECT doc_id, doc_id FROM documents
        UNION
        SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
    )
    SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, min(other) AS component_id
    FROM documents d LEFT JOIN sizes USING (doc_id) JOIN reach USING (doc_id) GROUP BY d.doc_id, n
    """,
)
def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_groups(table(spark, sf_dir, "documents"))


@query("op2_html_extraction")
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query("op4_nearest_neighbours")
def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(vectors, vectors.filter("vec_id % 50 = 0"))


@query("op3_training_order")
def op3_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids are the UTF-8 bytes of the texts: the byte-level vocabulary, one byte an id."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").cast("binary").alias("tokens"))
    folder = scratch_folder(spark, "order")
    order.materialise(docs, folder, key=20_240_607)
    return order.read_shards(spark, folder).select(
        "slot", "shard", "byte_offset", "doc_id", "part", "n_tokens", F.sha2("tokens", 256).alias("tokens_sha256")
    )


@query("op11_language_id")
def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.predict(docs, language.train(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op13_embedding_whitening")
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c")
    return done.select("id", "n", "deviation", "identity_error", each).select(
        F.col("id").alias("vec_id"),
        (F.col("at") + 1).cast("int").alias("component"),
        "n",
        "deviation",
        F.col("c.whitened").alias("whitened"),
        F.col("c.explained").alias("explained"),
        "identity_error",
    )


@query(
    "op12_prefix_trie",
    r"""
    WITH RECURSIVE ordered AS (
        SELECT conv_id AS c, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, ''))
               ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS l
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
    ), crc_table AS (
        SELECT v, v AS x, 0 AS step FROM range(256) t(v)
        UNION ALL
        SELECT v, CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END, step + 1 FROM crc_table WHERE step < 8
    ), crc AS (
        SELECT list(x ORDER BY v) AS entries FROM crc_table WHERE step = 8
    ), heads AS (
        SELECT c, xor(list_reduce([4294967295::BIGINT] || [ascii(ch)::BIGINT FOR ch IN string_split(c::VARCHAR, '')],
               LAMBDA a, b: xor(a // 256, entries[xor(a, b) % 256 + 1])), 4294967295) % 9 AS h
        FROM ordered, crc
    ), rebuilt AS (
        SELECT o.c, list_concat(coalesce(b.l[1:h], []), o.l[h + 1:]) AS l
        FROM ordered o JOIN heads USING (c) LEFT JOIN ordered b ON b.c = o.c - o.c % 5
    ), prefixes AS (
        SELECT c, d, l[1:d] AS p, len(l) = d AS ended FROM rebuilt, unnest(range(0, len(l) + 1)) t(d)
    ), nodes AS (
        SELECT p, d, min(c) AS c, count(*) AS n,
               sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ended), '')) AS ends
        FROM prefixes GROUP BY p, d
    ), named AS (
        SELECT n.*, q.c AS parent, CASE WHEN n.d > 0 THEN (n.n - 1) * strlen(n.p[n.d].t) ELSE 0 END AS saved
        FROM nodes n LEFT JOIN nodes q ON q.d = n.d - 1 AND q.p = n.p[1:n.d - 1]
    ), children AS (
        SELECT parent, d - 1 AS d, count(*) AS k FROM named WHERE d > 0 GROUP BY ALL
    ), below AS (
        SELECT a.p, a.d, sum(CASE WHEN k IS NULL THEN 1 ELSE 0 END) AS leaves, sum(b.saved) AS saved
        FROM named b LEFT JOIN children x ON x.parent = b.c AND x.d = b.d
        JOIN named a ON a.d <= b.d AND a.p = b.p[1:a.d] GROUP BY a.p, a.d
    )
    SELECT n.c AS conv_id, n.d AS depth, n.parent AS parent_conv_id, n.n AS n_convs, coalesce(k, 0)::BIGINT AS n_children,
           leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, ends AS ends_sha256
    FROM named n JOIN below b ON b.d = n.d AND b.p = n.p LEFT JOIN children x ON x.parent = n.c AND x.d = n.d
    """,
)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = prefix_trie.turns(table(spark, sf_dir, "conversations"))
    sequences, lengths = prefix_trie.rebuilt(placed)
    names = {"conv": "conv_id", "parent_conv": "parent_conv_id", "members": "n_convs", "children": "n_children"}
    names |= {"leaves": "n_leaves", "saved": "saved_tokens"}
    return prefix_trie.trie(sequences, lengths).withColumnsRenamed(names)
