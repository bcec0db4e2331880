"""Secret scan: rule matches plus strings that a character Markov model takes for random. DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from traitloom.llm.common import ref

# Fixed values of the rule part: kind, pattern, capturing group that is measured, least length of it.
ASSIGN = (
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
RULES = (
    ("assign", ASSIGN, 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
#: Every assignment holds one of these once its letters are small.
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

NO_SPANS = "array<struct<start:int,end:int>>"

MARKOV = "markov"
#: Characters of key material and of identifiers; every other character ends a candidate.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
#: Shortest candidate the model is asked about.
MIN_CANDIDATE = 20
CANDIDATE = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{MIN_CANDIDATE},}}+"
#: Mean log-likelihood ratio per character (in nats) from which a candidate counts as random.
THRESHOLD = 0.5
#: Labelled samples of either kind the model is fitted on, at most.
MAX_SAMPLES = 20_000


def _characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


#: Hits that are worked on together. A step copies what it has found so far, so long lists are cut in blocks.
BLOCK = 256


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _blocks(items: Column, work) -> Column:
    """``work(block)`` for every ``BLOCK`` consecutive elements, as an array."""
    count = F.ceil(F.size(items) / BLOCK).cast("int")
    numbers = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(numbers, lambda b: work(F.slice(items, b * BLOCK + 1, F.lit(BLOCK))))


def _running(values: Column, add) -> Column:
    """``[0, add(0, v1), add(add(0, v1), v2), ...]``, one element more than there are values; for short lists."""
    start = F.array(F.lit(0))
    return F.aggregate(values, start, lambda line, v: F.concat(line, F.array(add(F.element_at(line, -1), v))))


def _places(lengths: Column, add) -> Column:
    """``_running`` for lists of any length: within blocks, then over the blocks. What is copied grows with the list."""

    def joined(blocks: Column) -> Column:
        ends = _running(F.transform(blocks, lambda line: F.element_at(line, -1)), add)
        shifted = F.zip_with(blocks, F.slice(ends, 1, F.size(blocks)), lambda line, before: F.transform(line, lambda v: add(before, v)))
        inner = F.flatten(F.transform(shifted, lambda line: F.slice(line, 1, F.size(line) - 1)))
        return F.concat(inner, F.array(F.element_at(ends, -1)))

    return _let(_let(lengths, lambda whole: _blocks(whole, lambda block: _running(block, add))), joined)


def _matches(text: Column, pattern: str, kept) -> Column:
    """``array<struct<start, end>>`` in code points of the matches for which ``kept(match)`` holds.

    The pieces between the matches and the matches themselves alternate, so running lengths are the positions: both
    are read once, and a text of any length, with any number of matches, is handled whole.
    """
    gaps = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    lengths = F.zip_with(gaps, hits, lambda gap, hit: F.length(gap) + F.coalesce(F.length(hit), F.lit(0)))
    ends = _places(lengths, lambda at, n: at + n)

    def spans(both: Column) -> Column:
        hit_ends = F.slice(both["ends"], 2, F.size(both["hits"]))
        found = F.zip_with(
            both["hits"], hit_ends, lambda hit, end: F.when(kept(hit), F.struct((end - F.length(hit)).alias("start"), end.alias("end")))
        )
        return F.filter(found, lambda span: span.isNotNull())

    return _let(F.struct(hits.alias("hits"), ends.alias("ends")), spans)


def rule_spans(text: Column, kind: str) -> Column:
    """Spans of one rule; texts without a trace of it are passed over with a quick search.

    For access keys and hex strings the least length stands in the pattern, for a run that is too short never hides a
    longer one; the look-behind only keeps the search from trying a run again from each of its characters. An
    assignment that is too short does hide what it covers, so its length is tested after matching.
    """
    _, pattern, group, least = next(rule for rule in RULES if rule[0] == kind)
    if kind == "assign":
        low = F.lower(text)
        trace = F.lit(False)
        for word in _ASSIGN_WORDS:
            trace = trace | F.contains(low, F.lit(word))
        found = _matches(text, pattern, lambda hit: F.length(F.regexp_extract(hit, pattern, group)) >= least)
    elif kind == "access":
        trace = F.contains(text, F.lit("AKIA"))
        found = _matches(text, f"AKIA[A-Z0-9]{{{least - 4},}}+", lambda hit: hit.isNotNull())
    else:
        fast = f"(?<![0-9a-f])[0-9a-f]{{{least},}}+"
        trace = text.rlike(fast)
        found = _matches(text, fast, lambda hit: hit.isNotNull())
    return F.when(trace, found).otherwise(F.array().cast(NO_SPANS))


def fit(samples: DataFrame, text: str = "text", label: str = "label") -> list[float]:
    """Log-likelihood ratios of character pairs, random (label 1) against ordinary (label 0).

    The result has one number per pair of alphabet characters, so its size does not depend on the samples. Pairs with
    a character outside the alphabet are left out; every pair is counted once more than seen (add-one smoothing).
    Null texts, null labels and other labels are ignored. Counting is a grouped sum, combined before the shuffle.
    """
    chars = _characters(F.coalesce(ref(text).cast("string"), F.lit("")))
    pair = F.zip_with(F.slice("c", 1, F.size("c") - 1), F.slice("c", 2, F.size("c") - 1), lambda a, b: F.concat(a, b))
    pairs = (
        samples.select(ref(label).cast("int").alias("label"), chars.alias("c"))
        .filter("label in (0, 1) and size(c) > 1")
        .select("label", F.explode(pair).alias("pair"))
    )
    in_alphabet = F.col("pair").rlike("^[A-Za-z0-9+/_=-]{2}$")
    rows = pairs.filter(in_alphabet).groupBy("label", "pair").agg(F.count("*").alias("n")).collect()
    return log_ratios({(row["label"], row["pair"]): row["n"] for row in rows})


def log_ratios(counts: Mapping[tuple[int, str], int]) -> list[float]:
    size = len(ALPHABET)
    table = []
    for a in ALPHABET:
        random = [counts.get((1, a + b), 0) + 1 for b in ALPHABET]
        plain = [counts.get((0, a + b), 0) + 1 for b in ALPHABET]
        total_random, total_plain = sum(random), sum(plain)
        table += [math.log(r / total_random) - math.log(p / total_plain) for r, p in zip(random, plain)]
    assert len(table) == size * size
    return table


def score(candidate: Column, model: list[float]) -> Column:
    """Mean log-likelihood ratio per character pair of a string over the alphabet; NULL for fewer than two characters."""
    ratios = F.split(F.lit(",".join(f"{x:.6f}" for x in model)), ",").cast("array<double>")
    size = len(ALPHABET)
    codes = F.transform(_characters(candidate), lambda c: F.instr(F.lit(ALPHABET), c))
    # The state holds the last code and the sum, so the string is walked once.
    start = F.struct(F.lit(0).alias("last"), F.lit(0.0).alias("sum"))

    def step(state: Column, code: Column) -> Column:
        ratio = F.element_at(ratios, (state["last"] - 1) * size + code)
        return F.struct(code.alias("last"), F.when(state["last"] > 0, state["sum"] + ratio).otherwise(F.lit(0.0)).alias("sum"))

    total = F.aggregate(codes, start, step, lambda state: state["sum"])
    return F.when(F.length(candidate) > 1, total / (F.length(candidate) - 1))


def markov_spans(text: Column, model: list[float], threshold: float = THRESHOLD) -> Column:
    found = _matches(text, CANDIDATE, lambda hit: score(hit, model) >= threshold)
    return F.when(text.rlike(CANDIDATE), found).otherwise(F.array().cast(NO_SPANS))


def _labelled(spans: Column, rank: int, kind: str) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), s["end"].alias("end")
        ),
    )


def scan(
    docs: DataFrame, model: list[float], text: str = "text", threshold: float = THRESHOLD, column: str = "secrets"
) -> DataFrame:
    """The rows with one more column: every span found, ``array<struct<start, rank, kind, end>>`` by start, then rank.

    Ranks follow the order assign, access, hex, markov; positions are code points, the end is exclusive. A null text is
    an empty one and has no spans. Spans of different kinds may overlap. All other columns stay as they are; a column
    that already has the new name is replaced.
    """
    whole = F.coalesce(ref(text).cast("string"), F.lit(""))
    parts = [_labelled(rule_spans(whole, kind), rank, kind) for rank, (kind, *_) in enumerate(RULES)]
    parts.append(_labelled(markov_spans(whole, model, threshold), len(RULES), MARKOV))
    return docs.withColumn(column, F.array_sort(F.concat(*parts)))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def merged(spans: Column) -> Column:
    """Spans in order of their starts, put together where they overlap: ``array<struct<start, end>>``."""

    def put(found: Column) -> Column:
        # How far the spans before reach; a span that begins at or behind that is the first of a run.
        before = F.slice(found["reach"], 1, F.size(found["spans"]))
        starts = F.filter(F.zip_with(found["spans"], before, lambda s, r: F.when(s["start"] >= r, s["start"])), lambda x: x.isNotNull())
        # A run ends where the spans up to the next run's first have reached.
        firsts = F.zip_with(found["spans"], before, lambda s, r: s["start"] >= r)
        ends = F.filter(F.zip_with(F.slice(firsts, 2, F.size(firsts)), F.slice(before, 2, F.size(before)), lambda f, r: F.when(f, r)), lambda x: x.isNotNull())
        ends = F.concat(ends, F.array(F.element_at(found["reach"], -1)))
        return F.zip_with(starts, F.slice(ends, 1, F.size(starts)), lambda a, b: F.struct(a.alias("start"), b.alias("end")))

    reach = _places(F.transform(spans, lambda s: s["end"]), lambda at, end: F.greatest(at, end))
    return _let(F.struct(spans.alias("spans"), reach.alias("reach")), put)


def redact(docs: DataFrame, text: str = "text", spans: str = "secrets", mask: str = "[SECRET]") -> DataFrame:
    """The text with every span replaced by ``mask``; overlapping spans become one mask. NULL stays NULL.

    The text is cut at every ``BLOCK``-th span first and at the spans of a block then, for finding a place in a text takes as long
    as the text before it.
    """
    whole = ref(text)

    def gaps(part: Column, block: Column, first: Column) -> Column:
        """What stands before each span of a block, ``part`` being the text from ``first`` to the end of the last one."""
        starts = F.concat(F.array(first), F.transform(block, lambda s: s["end"]))
        return F.array_join(
            F.zip_with(block, F.slice(starts, 1, F.size(block)), lambda s, a: F.concat(F.substring(part, a - first + 1, s["start"] - a), F.lit(mask))), ""
        )

    def cut(runs: Column) -> Column:
        def work(blocks: Column) -> Column:
            firsts = F.concat(F.array(F.lit(0)), F.transform(blocks, lambda block: F.element_at(block, -1)["end"]))

            def piece(block: Column, first: Column) -> Column:
                return _let(F.substring(whole, first + 1, F.element_at(block, -1)["end"] - first), lambda part: gaps(part, block, first))

            texts = F.zip_with(blocks, F.slice(firsts, 1, F.size(blocks)), piece)
            return F.concat(F.array_join(texts, ""), F.substring(whole, F.element_at(firsts, -1) + 1, F.length(whole)))

        return _let(_blocks(runs, lambda block: block), work)

    return docs.withColumn(text, F.when(F.size(ref(spans)) > 0, _let(merged(ref(spans)), cut)).otherwise(whole))


def random_samples(spark: SparkSession, n: int = MAX_SAMPLES) -> DataFrame:
    """``n`` labelled random strings (label 1) over the alphabets keys are written in, 20 to 51 characters long.

    Every string is cut from hashes of its number, so the rows are the same on every run.
    """
    i = F.col("id")
    long_hex = F.concat(*[F.sha2(F.concat_ws("/", F.lit(f"s{k}"), i), 256) for k in range(2)])
    base64 = F.base64(F.unhex(long_hex))
    base32 = F.upper(F.concat(*[F.lower(F.conv(F.substring(long_hex, 1 + 10 * k, 10), 16, 36)) for k in range(8)]))
    mixed = F.regexp_replace(base64, "[+/=]", "")
    size = (20 + F.pmod(F.xxhash64(i), F.lit(32))).cast("int")
    body = F.element_at(F.array(long_hex, base64, base32, mixed), (F.pmod(i, F.lit(4)) + 1).cast("int"))
    return spark.range(n).select(F.lit(1).alias("label"), F.substring(body, F.lit(1), size).alias("text"))


def word_samples(docs: DataFrame, text: str = "text", n: int = MAX_SAMPLES, texts: int = 2_000) -> DataFrame:
    """At most ``n`` ordinary identifiers (label 0): words of letters only, from at most ``texts`` different texts.

    The texts are those with the smallest hashes, copies counted once; the words are the longest ones (ties by spelling):
    long words are what a random string could be mistaken for. Both bounds are parameters of the fit, not of the scan.
    """
    whole = docs.select(ref(text).cast("string").alias("t")).filter("t is not null")
    hashes = whole.select(F.xxhash64("t").alias("h")).distinct().orderBy("h").limit(texts)
    # The hashes are chosen first, so that only the texts that have one of them are shuffled.
    own = whole.select(F.xxhash64("t").alias("h"), "t").join(F.broadcast(hashes), "h")
    chosen = own.select("t").distinct().orderBy(F.xxhash64("t"), "t").limit(texts)
    words = chosen.select(F.explode(F.regexp_extract_all("t", F.lit("[A-Za-z]{4,}"), F.lit(0))).alias("text")).distinct()
    kept = words.orderBy(F.length("text").desc(), "text").limit(n)
    return kept.select(F.lit(0).alias("label"), "text")


def identifier_samples(words: DataFrame) -> DataFrame:
    """Ordinary identifiers (label 0) made of ordinary words: snake and camel case, constants, paths, hyphens, with numbers.

    Words are taken three at a time, by their hashes; a group is as small whatever the number of words.
    """
    groups = words.groupBy(F.pmod(F.xxhash64("text"), F.lit(MAX_SAMPLES // 3)).alias("g")).agg(F.sort_array(F.collect_list(F.lower("text"))).alias("w"))
    w, number = F.slice("w", 1, 4), F.pmod(F.xxhash64("w"), F.lit(10_000)).cast("string")
    camel = F.array_join(F.transform(w, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.substring(x, 2, 1_000))), "")
    forms = [
        F.array_join(w, "_"),
        F.upper(F.array_join(w, "_")),
        F.array_join(w, "-"),
        F.array_join(w, "/"),
        camel,
        F.concat(F.lower(F.substring(camel, 1, 1)), F.substring(camel, 2, 1_000)),
        F.concat(F.array_join(w, "_"), F.lit("_"), number),
        F.concat(F.lit("/v"), F.substring(number, 1, 1), F.lit("/"), F.array_join(w, "/"), F.lit("/"), number),
        F.concat(camel, number),
        F.concat(F.lit("--"), F.array_join(w, "-"), F.lit("="), number),
    ]
    return groups.select(F.lit(0).alias("label"), F.explode(F.array(*forms)).alias("text"))


def pattern_samples(spark: SparkSession, n: int = MAX_SAMPLES // 4) -> DataFrame:
    """``n`` labelled strings (label 0) that are long but no keys: numbers, dates, runs, repeats, sequences of few letters."""
    i = F.col("id")
    digits = F.concat(*[F.lpad(F.pmod(F.xxhash64(i, F.lit(k)), F.lit(10**9)).cast("string"), 9, "0") for k in range(4)])
    hexes = F.sha2(F.concat_ws("/", F.lit("p"), i), 256)
    few = [F.translate(F.substring(hexes, 1, 40), "0123456789abcdef", letters * (16 // len(letters))) for letters in ("ACGT", "01", "acgt", "-=")]
    date = F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), F.pmod(i, F.lit(9_000)).cast("int")), "yyyy-MM-dd")
    char = F.substring(F.lit(ALPHABET), (F.pmod(i, F.lit(len(ALPHABET))) + 1).cast("int"), F.lit(1))
    other = F.substring(F.lit(ALPHABET), (F.pmod(i * 7 + 3, F.lit(len(ALPHABET))) + 1).cast("int"), F.lit(1))
    forms = [
        digits,
        F.concat(date, F.lit("/"), F.substring(digits, 1, 6), F.lit("-"), F.substring(digits, 7, 6)),
        F.concat(F.translate(date, "-", ""), F.lit("_"), F.substring(digits, 1, 14)),
        F.repeat(char, 40),
        F.repeat(F.concat(char, other), 20),
        *few,
    ]
    form = F.element_at(F.array(*forms), (F.pmod(F.xxhash64(i, F.lit("form")), F.lit(len(forms))) + 1).cast("int"))
    return spark.range(n).select(F.lit(0).alias("label"), form.alias("text"))


def fit_on(docs: DataFrame, text: str = "text") -> list[float]:
    """The model of the scan: generated random strings against ordinary words of the texts themselves, identifiers made of
    them, and long strings that are no keys."""
    spark = docs.sparkSession
    words = word_samples(docs, text)
    ordinary = words.unionByName(identifier_samples(words)).unionByName(pattern_samples(spark))
    return fit(random_samples(spark).unionByName(ordinary))
