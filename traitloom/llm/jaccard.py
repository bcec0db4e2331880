"""N-gram Jaccard join in a metric space, and the groups its links make.

Jaccard distance is a metric, and so is its weighted form on counts. Shingles are counted in hash buckets; the distance of
two count vectors is never above the distance of the sets, so the vectors are a smaller metric space in which every pair of
near documents is near as well. Distances to pivots in it decide who must meet; the exact sets are compared only for pairs
that are near there.

1. First regions. A set, sorted by hash, is read as pairs of neighbours. Two near sets share a pair among the first
   ``prefix_length`` of either, so documents meet in the region of the smallest document that has one of their first pairs.
   Unrelated documents, whose distance is 1 to every pivot, meet nobody. ``keyed`` finds that document without bringing all
   holders of a pair to one place.
2. Size classes. A region is cut where sizes double; a document within reach of the next class is replicated to it.
3. Star. Each region has a pivot. Members whose set is near to it are its core: they are linked through it and need no
   comparison with each other. The rest is the ring. By the triangle inequality a core member can be near to a ring member
   only if its distance to the pivot is at least the smallest one in the ring less the radius; other core members leave.
4. Regions of up to ``LEAF`` members are joined: ring with ring and with what is left of the core, skipping pairs whose
   distances to the pivot differ by more than the radius. Larger ones get ``PIVOTS`` new pivots; a member goes to the Voronoi
   region of the nearest one and to every other one that is at most two radii farther, and those regions start at 3.
   Where the windows are so wide that splitting gains nothing, the region is joined in square tiles instead.

A task that joins members holds their exact sets. It contracts as it goes: members connected by links found earlier, there or
by the star, are not compared, so it returns fewer links than it has members, and a large group of near copies makes no list
of its pairs anywhere.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from traitloom.llm import keyed, tokens
from traitloom.llm.common import is_small, with_columns, written

WIDTH = 5
#: Two sets are near when NUMERATOR * union <= DENOMINATOR * intersection.
NUMERATOR, DENOMINATOR = 80, 100
RADIUS = 1 - NUMERATOR / DENOMINATOR
SLACK = 1e-9
LEAF = 256
TILE = 512
#: Bytes of the sets of a leaf or a tile, about.
TILE_BYTES = 64 << 20
#: Exact comparisons of a member between two looks at what it is connected to by then.
STEP = 32
PIVOTS = 8
DEPTH = 6
#: Ids that are sent to all tasks to select rows, at most; beyond it the selection is a shuffled join.
BROADCAST_IDS = 1_000_000
END = np.uint64(0)


def shingle_sets(column: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, one text after the other, and where each begins.

    Words are runs of characters other than ASCII white space, ASCII capitals made small. A text of fewer than ``width``
    words is one shingle, a text without words has none.
    """
    sets, sizes = [], []
    for _, n, raw, offsets in tokens.text_chunks(column):
        raw = tokens.lower_ascii(raw)
        start, end, row = tokens.word_spans(raw, offsets, tokens.WHITE_SPACE)
        words = tokens.span_hashes(raw, start, end)
        whole = tokens.window_hashes(words, width)
        at = np.flatnonzero(row[: len(whole)] == row[width - 1 :]) if len(whole) else np.zeros(0, dtype=np.int64)
        keys, rows = whole[at], row[at]
        bounds = np.searchsorted(row, np.arange(n + 1))
        counts = np.diff(bounds)
        few = np.flatnonzero((counts > 0) & (counts < width))
        if len(few):
            short = [tokens.window_hashes(words[bounds[i] : bounds[i + 1]], int(counts[i]))[0] for i in few]
            keys, rows = np.concatenate([keys, np.array(short, dtype=np.uint64)]), np.concatenate([rows, few])
        order = np.lexsort((keys, rows))
        keys, rows = keys[order], rows[order]
        fresh = np.ones(len(keys), dtype=bool)
        fresh[1:] = (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])
        sets.append(keys[fresh])
        sizes.append(np.bincount(rows[fresh], minlength=n))
    if not sets:
        return np.zeros(0, dtype=np.uint64), np.zeros(1, dtype=np.int64)
    return np.concatenate(sets), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])


def prefix_length(n: np.ndarray) -> np.ndarray:
    """How many first neighbour pairs of a set of ``n`` can hold all it shares with a near set, and one more.

    With ``a`` elements of its own and ``b`` of the other's, near means ``5 a + 4 b <= n``. An own element takes part in
    two pairs, a foreign one breaks one, so at most the largest ``2 a + b`` pairs are lost.
    """
    return 2 * (n // 5) + (n % 5 == 4) + (n > 0)


def first_pairs(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the first neighbour pairs of every set, and the row of each."""
    sizes = np.diff(starts)
    lengths = prefix_length(sizes)
    rows = np.repeat(np.arange(len(sizes)), lengths)
    offset = np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    at = starts[rows] + offset
    last = at + 1 >= starts[rows + 1]
    follow = np.where(last, END, values[np.minimum(at + 1, len(values) - 1)]) if len(at) else values[:0]
    return tokens.mix(values[at] * np.uint64(0x9E3779B97F4A7C15) + follow), rows


def size_class(n: int) -> int:
    return max(int(n), 1).bit_length() - 1


def sketch(values: np.ndarray) -> bytes:
    """Counts of the elements in equal ranges of the hash space, two to four elements to three ranges."""
    bits = max(4, size_class(len(values)) - 1)
    while True:
        counts = np.bincount((values >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
        if counts.max(initial=0) < 256:
            return counts.astype(np.uint8).tobytes()
        bits += 1


def folded(data: bytes, bits: int) -> np.ndarray:
    """The counts in ``2 ** bits`` ranges."""
    return np.frombuffer(data, dtype=np.uint8).reshape(1 << bits, -1).sum(axis=1, dtype=np.uint16)


def class_bits(cls: int) -> int:
    """Ranges compared in a size class: members that come from the class below have as many."""
    return max(4, cls - 2)


def _row_ids(table: pa.Table, group: int) -> np.ndarray:
    return (np.int64(group) << 32) + np.arange(table.num_rows, dtype=np.int64)


ROWS = (
    "rid long, doc_id long, n long, key1 long, key2 long, regional boolean, pivots array<long>, sketch binary, elements binary"
)


def place(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """One row per document (``ROWS``): its set's size and key, the pivots it goes to, and, if it meets anyone, its set."""
    groups, _, buckets = keyed.deal(docs, id_column, text)

    def extract(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        keys, rows = first_pairs(*shingle_sets(table["text"]))
        group = table["group"][0].as_py() if table.num_rows else 0
        return keys, _row_ids(table, group)[rows]

    def work(group: int, table: pa.Table, back: tuple[np.ndarray, np.ndarray]) -> pa.Table:
        values, starts = shingle_sets(table["text"])
        keys, rows = first_pairs(values, starts)
        ids = _row_ids(table, group)
        known, least, place = keyed.distinct_keys(keys, ids[rows])
        live = np.bincount(place, minlength=len(known)) > 1
        where = np.searchsorted(known, back[0])
        least[where] = np.minimum(least[where], back[1])
        live[where] = True
        meets = live[place]
        at, owner = rows[meets], least[place[meets]]
        order = np.lexsort((owner, at))
        at, owner = at[order], owner[order]
        fresh = np.ones(len(at), dtype=bool)
        fresh[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
        at, owner = at[fresh], owner[fresh]
        regional = np.bincount(at, minlength=table.num_rows) > 0
        foreign = owner != ids[at]
        at, owner = at[foreign], owner[foreign]
        ends = np.searchsorted(at, np.arange(table.num_rows + 1)).astype(np.int32)
        sets = [values[a:b] for a, b in zip(starts[:-1], starts[1:])]
        with np.errstate(over="ignore"):
            key1 = np.array([tokens.mix(s).sum(dtype=np.uint64) for s in sets], dtype=np.uint64).view(np.int64)
            key2 = np.array([tokens.mix(~s).sum(dtype=np.uint64) for s in sets], dtype=np.uint64).view(np.int64)
        return pa.table(
            {
                "rid": pa.array(ids),
                "doc_id": table["id"].cast(pa.int64()),
                "n": pa.array(np.diff(starts)),
                "key1": pa.array(key1),
                "key2": pa.array(key2),
                "regional": pa.array(regional),
                "pivots": pa.ListArray.from_arrays(pa.array(ends), pa.array(owner)),
                "sketch": pa.array([sketch(s) if r else None for s, r in zip(sets, regional)], pa.binary()),
                "elements": pa.array([s.tobytes() if r else None for s, r in zip(sets, regional)], pa.binary()),
            }
        )

    return keyed.finish(groups, keyed.shared_keys(groups, buckets, extract), work, ROWS)


def near(inner: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    return DENOMINATOR * inner >= NUMERATOR * (n + m - inner)


def distance(inner: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1 - inner / np.maximum(n + m - inner, 1)


def _selected(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose ``rid`` is listed."""
    ids = ids.select(F.col("rid").alias("__rid"))
    if is_small(ids, BROADCAST_IDS):
        ids = F.broadcast(ids)
    return rows.join(ids, F.col("rid") == F.col("__rid"), "left_semi")


def verified(pairs: DataFrame, placed: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose sets are near."""
    pairs = written(pairs.select("a", "b").distinct(), "pairs")
    ids = written(pairs.select(F.explode(F.array("a", "b")).alias("rid")).distinct(), "pair-ids")
    sets = written(_selected(placed.select("rid", "elements"), ids), "pair-sets")
    one = sets.select(F.col("rid").alias("a"), F.col("elements").alias("left"))
    two = sets.select(F.col("rid").alias("b"), F.col("elements").alias("right"))

    def make():
        def work(left: pa.Array, right: pa.Array) -> list[pa.Array]:
            out = []
            for x, y in zip(left, right):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                inner = len(np.intersect1d(x, y, assume_unique=True))
                out.append(bool(near(inner, len(x), len(y))))
            return [pa.array(out, pa.bool_())]

        return work

    joined = pairs.join(one, "a").join(two, "b")
    compared = with_columns(joined, ["left", "right"], StructType.fromDDL("left boolean, right boolean"), lambda: _twice(make()))
    return compared.filter("left").select("a", "b")


def _twice(work):
    def run(*columns):
        return work(*columns) * 2  # both inputs are replaced, so that no set is carried on

    return run


def _first_regions(members: DataFrame) -> DataFrame:
    """``region, cls, rid, n, sketch``: every member in its pivots' regions, by size class."""
    own = F.array(F.col("rid"))
    spread = members.select("rid", "n", "sketch", F.explode(F.array_union("pivots", own)).alias("pivot"))
    own_class = F.floor(F.log2(F.col("n").cast("double"))).cast("int")
    reach = DENOMINATOR * F.col("n") >= NUMERATOR * F.pow(F.lit(2.0), own_class + 1)
    classes = F.when(reach, F.array(own_class, own_class + 1)).otherwise(F.array(own_class))
    return spread.select(F.col("pivot").alias("region"), F.explode(classes).alias("cls"), "rid", "n", "sketch")


def _star(regions: DataFrame) -> DataFrame:
    """Adds ``pivot``, the distance ``d`` to it, and whether the pair has to be compared exactly (``close``)."""
    pivots = (
        regions.groupBy("region", "cls")
        .agg(F.min(F.struct("rid", "n", "sketch")).alias("pv"), F.count("*").alias("size"))
        .filter("size > 1")
    )
    joined = regions.join(pivots, ["region", "cls"]).select(
        "region", "cls", "rid", "n", "sketch", F.col("pv.rid").alias("pivot"), F.col("pv.n").alias("pn"), F.col("pv.sketch").alias("ps")
    )

    def make():
        def work(cls: pa.Array, n: pa.Array, data: pa.Array, pn: pa.Array, ps: pa.Array) -> list[pa.Array]:
            n, pn = n.to_numpy(), pn.to_numpy()
            inner = np.array(
                [
                    np.minimum(folded(x, bits), folded(y, bits)).sum(dtype=np.int64)
                    for x, y, bits in zip(data.to_pylist(), ps.to_pylist(), map(class_bits, cls.to_pylist()))
                ],
                dtype=np.int64,
            )
            return [pa.array(distance(inner, n, pn)), pa.array(near(inner, n, pn), pa.bool_())]

        return work

    made = with_columns(joined, ["cls", "n", "sketch", "pn", "ps"], StructType.fromDDL("d double, close boolean"), make)
    return made.select("region", "cls", "rid", "pivot", "d", "close")


def _open_members(star: DataFrame, links: DataFrame) -> DataFrame:
    """Ring members, and core members within reach of the ring; regions without a ring are done.

    ``label`` names what a member is known to be connected to: the pivot for the core, itself for the ring.
    """
    known = links.select(F.col("a").alias("pivot"), F.col("b").alias("rid"), F.lit(True).alias("core"))
    marked = star.filter("rid <> pivot").join(known, ["pivot", "rid"], "left").withColumn("core", F.coalesce("core", F.lit(False)))
    ring = marked.filter("not core").groupBy("region", "cls").agg(F.min("d").alias("ring_d"))
    kept = marked.join(ring, ["region", "cls"]).filter(~F.col("core") | (F.col("d") >= F.col("ring_d") - RADIUS - SLACK))
    return kept.select("region", "cls", "rid", "d", F.when(F.col("core"), F.col("pivot")).otherwise(F.col("rid")).alias("label"))


PAIRS = "a long, b long"


def _shared(one: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """How many elements of ``one`` each of the sets has; all are sorted and without repeats."""
    if not len(one):
        return np.zeros(len(sets), dtype=np.int64)
    ends = np.cumsum([len(s) for s in sets])
    every = np.concatenate(sets)
    at = np.minimum(np.searchsorted(one, every), len(one) - 1)
    hits = np.concatenate([[0], np.cumsum(one[at] == every)])
    return hits[ends] - hits[np.concatenate([[0], ends[:-1]])]


class Members:
    """The members of a region, or of a part of it, as arrays."""

    def __init__(self, table: pa.Table, cls: int):
        bits = class_bits(cls)
        sketches = [folded(data, bits) for data in table["sketch"].to_pylist()]
        self.rid, self.n, self.label, self.d = (table[c].to_numpy() for c in ("rid", "n", "label", "d"))
        self.counts = np.stack(sketches) if sketches else np.zeros((0, 1 << bits), np.uint16)
        self.sets = [np.frombuffer(x.as_buffer(), np.uint64) for chunk in table["elements"].chunks for x in chunk]


def _connect(left: Members, right: Members | None = None, tally: list[int] | None = None) -> pa.Table:
    """Links ``a, b`` that connect members with near sets, among ``left``, or between ``left`` and ``right``.

    Members that are connected already, by their labels or by links found here, are not compared: there are fewer links than
    members. Who is compared passes the triangle window, the sizes and the sketch first; what is linked is near by its exact
    set. ``tally`` collects the number of exact comparisons.
    """
    square = right is None
    right = left if square else right
    first, second = left.label.copy(), right.label.copy()
    if square:
        second = first
    links, compared = [], 0
    for i in range(len(left.rid)):
        mask = (second != first[i]) & (np.abs(right.d - left.d[i]) <= RADIUS + SLACK)
        mask &= DENOMINATOR * np.minimum(right.n, left.n[i]) >= NUMERATOR * np.maximum(right.n, left.n[i])
        if square:
            mask[: i + 1] = False
        js = np.flatnonzero(mask)
        if not len(js):
            continue
        js = js[near(np.minimum(right.counts[js], left.counts[i]).sum(axis=1, dtype=np.int64), right.n[js], left.n[i])]
        while len(js):
            some, js = js[:STEP], js[STEP:]
            compared += len(some)
            inner = _shared(left.sets[i], [right.sets[j] for j in some])
            for j in some[near(inner, right.n[some], left.n[i])]:
                if second[j] != first[i]:
                    links.append((min(left.rid[i], right.rid[j]), max(left.rid[i], right.rid[j])))
                    old, new = second[j], first[i]
                    first[first == old] = new
                    second[second == old] = new
            js = js[second[js] != first[i]]
    if tally is not None:
        tally.append(compared)
    found = np.array(links, dtype=np.int64).reshape(-1, 2)
    return pa.table({"a": pa.array(found[:, 0]), "b": pa.array(found[:, 1])})


def _held(most: int):
    """Members of a size class whose sets are held by one task: at most ``most``, fewer where sets are large."""
    by_size = F.floor(F.lit(TILE_BYTES) / F.pow(F.lit(2.0), F.col("cls") + 4))
    return F.greatest(F.lit(2), F.least(F.lit(most), by_size)).cast("int")


def _leaves(members: DataFrame) -> DataFrame:
    def run(key, table):
        return _connect(Members(table, key[1].as_py()))

    return members.groupBy("region", "cls").applyInArrow(run, PAIRS)


def _tiles(members: DataFrame, cores: DataFrame) -> DataFrame:
    """Links of regions that splitting does not help, in square tiles, the members of a tile first and then tile with tile.

    After the first step a member is labelled with its component. The largest component of a region goes to tiles of its own,
    which meet no other such tile, and a region that is one component by then is done. So a group of near copies costs a
    comparison of tiles once, and no step returns more links than there are members in a task.
    """
    dealt = members.withColumn("tile", F.pmod(F.xxhash64("rid"), F.ceil(F.col("size") / _held(TILE)).cast("int")))

    def inside(key, table):
        return _connect(Members(table, key[1].as_py()))

    inner = written(dealt.groupBy("region", "cls", "tile").applyInArrow(inside, PAIRS), "inner")
    roots = components(inner.unionByName(cores)).select("rid", "root")
    known = written(dealt.drop("label", "tile").join(roots, "rid", "left").withColumn("label", F.coalesce("root", "rid")).drop("root"), "labelled")
    by_label = known.groupBy("region", "cls", "label").agg(F.count("*").alias("k"))
    largest = by_label.groupBy("region", "cls").agg(F.max(F.struct("k", F.negate("label").alias("label"))).alias("m"), F.sum("k").alias("all"))
    largest = largest.filter("m.k < all").select("region", "cls", F.negate(F.col("m.label")).alias("main"), F.col("m.k").alias("k"), F.col("all"))
    parts = known.join(largest, ["region", "cls"])
    tiles = [F.ceil(n / _held(TILE)).cast("int") for n in (F.col("all") - F.col("k"), F.col("k"))]
    parts = parts.withColumn("few", tiles[0]).withColumn("many", tiles[1]).withColumn("is_main", F.col("label") == F.col("main"))
    own = F.when(F.col("is_main"), F.col("few") + F.pmod(F.xxhash64("rid"), F.col("many"))).otherwise(F.pmod(F.xxhash64("rid"), F.col("few")))
    others = F.sequence(F.lit(0), F.when(F.col("is_main"), F.col("few")).otherwise(F.col("few") + F.col("many")) - 1)
    met = parts.withColumn("tile", own.cast("int")).select("*", F.explode(others).alias("other")).filter("tile <> other")
    met = met.select(
        "region", "cls", "rid", "n", "sketch", "elements", "label", "d", "tile", F.least("tile", "other").alias("t1"), F.greatest("tile", "other").alias("t2")
    )

    def across(key, table):
        cls, t1, t2 = key[1].as_py(), key[2].as_py(), key[3].as_py()
        one, two = (Members(table.filter(pc.equal(table["tile"], t)), cls) for t in (t1, t2))
        return _connect(one, two)

    # Members that fell into one tile and are of one component by now met in the first step only if that tile was theirs then.
    again = parts.withColumn("tile", own.cast("int")).filter("not is_main")
    same = again.groupBy("region", "cls", "tile").applyInArrow(inside, PAIRS)
    outer = met.groupBy("region", "cls", "t1", "t2").applyInArrow(across, PAIRS)
    return inner.unionByName(same).unionByName(outer)


def _voronoi(members: DataFrame, depth: int) -> DataFrame:
    """``region, cls, rid, n, sketch, sub``: each member with the new regions it belongs to."""
    draws = [
        F.min(F.struct(F.xxhash64("rid", F.lit(depth * PIVOTS + k)).alias("h"), "rid", "n", "sketch")).alias(f"p{k}")
        for k in range(PIVOTS)
    ]
    drawn = members.groupBy("region", "cls").agg(*draws)
    pivots = drawn.select("region", "cls", F.array(*[F.struct(f"p{k}.rid", f"p{k}.n", f"p{k}.sketch") for k in range(PIVOTS)]).alias("pv"))
    joined = members.join(pivots, ["region", "cls"])

    def make():
        def work(cls: pa.Array, n: pa.Array, data: pa.Array, pv: pa.Array) -> list[pa.Array]:
            subs = []
            for c, size, mine, pivots in zip(cls.to_pylist(), n.to_pylist(), data.to_pylist(), pv.to_pylist()):
                bits = class_bits(c)
                own = folded(mine, bits)
                far = {}
                for p in pivots:
                    if p["rid"] not in far:
                        inner = int(np.minimum(own, folded(p["sketch"], bits)).sum(dtype=np.int64))
                        far[p["rid"]] = float(distance(inner, size, p["n"]))
                reach = min(far.values()) + 2 * RADIUS + SLACK
                subs.append([p for p, d in far.items() if d <= reach])
            return [pa.array(subs, pa.list_(pa.int64()))]

        return work

    return with_columns(joined, ["cls", "n", "sketch", "pv"], StructType.fromDDL("pv array<long>"), make).withColumnRenamed("pv", "sub")


def links_of(placed: DataFrame, members: DataFrame) -> DataFrame:
    """Links ``a, b`` that connect every two members whose sets are near, directly or through others that are."""
    spark = placed.sparkSession
    regions = _first_regions(members)
    links = []
    for depth in range(DEPTH + 1):
        star = written(_star(regions), "star")
        cores = written(verified(star.filter("close and rid <> pivot").select(F.col("pivot").alias("a"), F.col("rid").alias("b")), placed), "cores")
        links.append(cores)
        left = _open_members(star, cores)
        sizes = left.groupBy("region", "cls").agg(F.count("*").alias("size")).filter("size > 1")
        left = written(left.join(sizes, ["region", "cls"]), "left")
        sets = _selected(placed.select("rid", "n", "sketch", "elements"), left.select("rid").distinct())
        open_members = written(left.join(sets, "rid"), "open")
        links.append(written(_leaves(open_members.filter(F.col("size") <= _held(LEAF))), "links"))
        large = open_members.filter(F.col("size") > _held(LEAF))
        if large.isEmpty():
            break
        if depth == DEPTH:
            links.append(written(_tiles(large, cores), "links"))
            break
        split = written(_voronoi(large.drop("elements"), depth), "split")
        cells = split.select("region", "cls", "size", F.explode("sub").alias("to")).groupBy("region", "cls", "size", "to").agg(F.count("*").alias("m"))
        gain = cells.groupBy("region", "cls", "size").agg(F.sum("m").alias("total"), F.max("m").alias("most"))
        useful = gain.filter("total <= 1.5 * size and most <= 0.8 * size").select("region", "cls")
        links.append(written(_tiles(large.join(useful, ["region", "cls"], "left_anti"), cores), "links"))
        parts = split.join(useful, ["region", "cls"], "left_semi")
        regions = written(
            parts.select(F.explode("sub").alias("to"), "region", "cls", "rid", "n", "sketch").select(
                F.xxhash64("region", "to").alias("region"), "cls", "rid", "n", "sketch"
            ),
            "regions",
        )
        if regions.isEmpty():
            break
    out = spark.createDataFrame([], PAIRS)
    for part in links:
        out = out.unionByName(part)
    return out


def components(links: DataFrame) -> DataFrame:
    """``rid, root``: the smallest member of each connected component, for members that have a link.

    Large-star and small-star steps in turn; each hooks all neighbours of a node to the smallest of them, by a grouped
    minimum and a join with it, so a node with very many neighbours is never one task's list. Every round is written down.
    """
    def orient(e: DataFrame) -> DataFrame:
        return e.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = written(orient(links), "edges")
    seen = mark(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = orient(both.filter("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")))
        large = written(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hooked = large.join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        edges = written(orient(hooked.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b")))), "small-star")
        now = mark(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("rid"), F.col("v").alias("root"))


def near_groups(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row: the smallest id reachable by links, its own included.

    Two documents are linked when the Jaccard similarity of their shingle sets is at least 0.8. A null or empty text, or one
    without words, has no shingles and no links; its group is itself. Documents with equal sets are one class from the
    start, so a large group of copies costs one comparison. Rows that repeat an id are separate documents that share it. A
    row without an id takes part, and counts last among the ids of its group. Other columns are not carried.
    """
    placed = written(place(docs, id_column, text), "placed")
    classes = placed.filter("n > 0").groupBy("key1", "key2", "n").agg(F.min("rid").alias("rep"))
    reps = classes.select(F.col("rep").alias("__rep"))
    members = written(
        placed.filter("regional").select("rid", "n", "pivots", "sketch").join(reps, F.col("rid") == F.col("__rep"), "left_semi"),
        "members",
    )
    roots = written(components(links_of(placed, members)), "roots")
    rows = placed.select("rid", "doc_id", "n", "key1", "key2").join(classes, ["key1", "key2", "n"], "left")
    rows = rows.select("doc_id", "n", F.coalesce("rep", "rid").alias("rep"))
    rooted = rows.join(roots.withColumnRenamed("rid", "rep"), "rep", "left").select("doc_id", "n", F.coalesce("root", "rep").alias("root"))
    rooted = written(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("members"))
    shared = least.filter("members > 1").select("root", "component_id")
    return rooted.join(shared, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )
