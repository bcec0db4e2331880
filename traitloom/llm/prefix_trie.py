"""Prefix trie of conversations with subtree totals by time-forward processing.

A node is a distinct sequence of first turns; its members are the conversations that start with it. Nodes get a key by
hashing the turns from the front, 128 bits of SHA-256, so that a node's row is found by grouping on the key. What is added up
over subtrees (children, leaves, saved bytes) travels from a node to its parent as a message.

**Classes and shards.** A node with ``n`` members is of class ``floor(log(n) / log(FAN))``; the root has a class of its own
above all. Along a conversation the class never rises, so the nodes of one class fall into trees: their tops are the shard
roots. A tree of class ``k`` has fewer than ``FAN`` nodes at any depth, whatever the corpus holds, so trees are dealt to
tasks by the hash of their root and no turn that all conversations share lands in one task. Classes are worked on from the
lowest: within a task, nodes come sorted by falling depth and messages wait in a queue that spills; the totals of the shard
roots are then added up by parent, in Spark, and are the first messages of the class above. The tail of a conversation
that nothing else shares is no tree at all: its totals are known without any message.

**Long conversations.** Turns are numbered over range partitions, so one conversation may span many tasks; keys are hashed in
blocks of ``BLOCK`` turns, and over the digests of whole blocks in the same way again.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from traitloom.llm.common import is_small, ref, written

#: Members of a node of one class are fewer than this many times the least of its class.
FAN = 4_096
#: Turns of a conversation that are hashed together.
BLOCK = 32
#: Messages that wait in memory; more are written out as a sorted run.
QUEUE = 1 << 18
#: Rows of a table that may be broadcast. Decides how a join is done, never its result.
BROADCAST_ROWS = 100_000
ROOT = b""

_TURN = "conv long, pos long, digest binary, bytes long"


def _sha(value: Column) -> Column:
    return F.substring(F.unhex(F.sha2(value, 256)), 1, 16)


def turns(conversations: DataFrame, conv="conv_id", turn="turn", role="role", text="text") -> DataFrame:
    """``conv, pos, digest, bytes``: every turn with its place in its conversation, from 0.

    Ordered by ``turn``, null first, equal ones by their digest. Null roles and texts are empty. Rows without a conversation id
    belong to none and are left out. Texts are hashed at the scan and never shuffled.
    """
    who, said = (F.coalesce(ref(c).cast("string"), F.lit("")) for c in (role, text))
    # The length in front of the role keeps (role, text) pairs apart that read the same when joined.
    digest = _sha(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said))
    slim = conversations.filter(ref(conv).isNotNull()).select(
        ref(conv).cast("long").alias("conv"), ref(turn).alias("turn"), digest.alias("digest"), F.octet_length(said).cast("long").alias("bytes")
    )
    slim = written(slim, "turns")
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("digest")]
    tasks = max(1, int(slim.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, done = None, 0
        for batch in batches:
            ids = batch["conv"].to_numpy()
            if not len(ids):
                continue
            new = np.concatenate([[ids[0] != last], ids[1:] != ids[:-1]])
            at = np.arange(len(ids))
            place = at - np.maximum.accumulate(np.where(new, at, 0))
            going_on = np.cumsum(new) == 0
            place[going_on] += done
            last, done = ids[-1], int(place[-1]) + 1
            columns = [batch["task"], batch["conv"], pa.array(place, pa.int64()), batch["digest"], batch["bytes"]]
            yield pa.RecordBatch.from_arrays(columns, ["task", "conv", "pos", "digest", "bytes"])

    dealt = slim.repartitionByRange(tasks, *order).sortWithinPartitions(*order).withColumn("task", F.spark_partition_id())
    local = written(dealt.mapInArrow(number, f"task int, {_TURN}"), "numbered")
    # Only a conversation that goes on from an earlier task has an offset: one a task at most.
    counts = local.groupBy("conv", "task").agg((F.max("pos") + 1).alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.withColumn("before", before).filter("before > 0").select("conv", "task", "before")
    placed = local.join(F.broadcast(offsets), ["conv", "task"], "left")
    return placed.select("conv", (F.col("pos") + F.coalesce("before", F.lit(0))).alias("pos"), "digest", "bytes")


def rebuilt(placed: DataFrame, group: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """The conversations with their first turns taken from the first of their group.

    With ``h = crc32(id) % heads`` and ``b = id - id % group``: the first ``h`` turns of ``b``, then the own turns after the
    first ``h``. Returns the turns, ``last`` marking the end of each conversation, and ``conv, length`` of every conversation,
    turnless ones included. A conversation's own turns are joined in chunks, so a long one is not one key.
    """
    chunk = 4_096
    head = (F.crc32(F.col("conv").cast("string").cast("binary")) % heads).cast("long")
    convs = placed.groupBy("conv").agg(F.count("*").alias("n"))
    first = placed.filter((F.col("conv") % group == 0) & (F.col("pos") < heads - 1))
    turn = F.struct("pos", "digest", "bytes")
    starts = first.groupBy(F.col("conv").alias("base")).agg(F.sort_array(F.collect_list(turn)).alias("start"))
    convs = convs.withColumn("base", F.col("conv") - F.col("conv") % group).withColumn("head", head)
    convs = convs.join(starts, "base", "left").withColumn("start", F.coalesce("start", F.array()))
    convs = convs.withColumn("start", F.slice("start", 1, F.col("head").cast("int")))
    convs = convs.withColumn("taken", F.size("start").cast("long"))
    left = F.greatest(F.col("n") - F.col("head"), F.lit(0))
    convs = written(convs.withColumn("length", F.col("taken") + left).drop("base"), "conversations")
    given = convs.select("conv", "length", F.explode("start").alias("t")).select("conv", "t.pos", "t.digest", "t.bytes", "length")
    chunks = F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {chunk}"))
    shifts = convs.filter("n > head").select("conv", "head", "taken", "length", F.explode(chunks).alias("chunk"))
    own = placed.withColumn("chunk", F.expr(f"pos div {chunk}")).join(shifts, ["conv", "chunk"]).filter("pos >= head")
    own = own.select("conv", (F.col("pos") - F.col("head") + F.col("taken")).alias("pos"), "digest", "bytes", "length")
    both = given.unionByName(own).withColumn("last", F.col("pos") == F.col("length") - 1).drop("length")
    return written(both, "rebuilt"), convs.select("conv", "length")


def prefixes(sequences: DataFrame, longest: int, block: int = BLOCK) -> DataFrame:
    """The rows ``conv, pos, digest, ...`` with ``node``, the key of the prefix that ends there, and ``parent``, that before it.

    Within a block of turns the key is the hash of the digests so far; behind the first block it also covers the key of the
    blocks before, which are sequences of block digests and treated in the same way.
    """
    path = Window.partitionBy("conv", "block").orderBy("pos")
    so_far = _sha(F.array_join(F.transform(F.collect_list("digest").over(path), F.hex), ""))
    cut = sequences.withColumn("block", F.expr(f"pos div {block}"))
    if longest <= block:
        return cut.withColumn("node", so_far).withColumn("parent", F.coalesce(F.lag("node").over(path), F.lit(ROOT))).drop("block")
    cut = written(cut.withColumn("within", so_far), "blocks")
    whole = cut.filter(F.col("pos") % block == block - 1).select("conv", F.col("block").alias("pos"), F.col("within").alias("digest"))
    above = prefixes(whole, -(-longest // block), block)
    # Of the block before: the key of the blocks up to it, and the key of the prefix that ends with it.
    entry = _sha(F.concat("parent", "digest"))
    above = above.select("conv", (F.col("pos") + 1).alias("block"), F.col("node").alias("front"), entry.alias("entry"))
    own = cut.join(above, ["conv", "block"], "left")
    own = own.withColumn("node", _sha(F.concat(F.coalesce("front", F.lit(ROOT)), "within")))
    before = F.coalesce(F.lag("node").over(path), F.col("entry"), F.lit(ROOT))
    return own.withColumn("parent", before).drop("block", "within", "front", "entry")


class SpillingQueue:
    """Messages in the order of their receivers: deepest first, then by key.

    At most ``limit`` wait in memory; then all of them are written as a sorted run to an unnamed file that only this task can
    see and that goes with it. The runs are read back in small pieces and merged with what is in memory.
    """

    _RECORD = np.dtype([("depth", "<i8"), ("key", "V16"), ("children", "<i8"), ("leaves", "<i8"), ("saved", "<i8")])

    def __init__(self, limit: int = QUEUE, most_runs: int = 64):
        self.limit, self.most_runs, self.heap, self.runs, self.spilled = limit, most_runs, [], [], 0
        self.numbers = itertools.count()

    def push(self, depth: int, key: bytes, children: int, leaves: int, saved: int) -> None:
        heapq.heappush(self.heap, (-depth, key, children, leaves, saved))
        if len(self.heap) > self.limit:
            self.heap.sort()
            self._spill(self.heap)
            self.heap = []
            if len(self.runs) > self.most_runs:
                runs = [itertools.chain([row], rest) for row, _, rest in self.runs]
                self.runs = []
                self._spill(heapq.merge(*runs))

    def _spill(self, rows: Iterable[tuple]) -> None:
        file, rows = tempfile.TemporaryFile(), iter(rows)
        while part := list(itertools.islice(rows, 1024)):
            file.write(np.array(part, dtype=self._RECORD).tobytes())
        file.seek(0)
        self.spilled += 1
        self._next(self._read(file))

    def _read(self, file) -> Iterator[tuple]:
        with file:
            while data := file.read(1024 * self._RECORD.itemsize):
                yield from np.frombuffer(data, dtype=self._RECORD).tolist()

    def _next(self, run: Iterator[tuple]) -> None:
        row = next(run, None)
        if row is not None:
            heapq.heappush(self.runs, (row, next(self.numbers), run))

    def take(self, depth: int, key: bytes) -> tuple[int, int, int]:
        """The sum of all messages to a node, which must be the next in order that has any."""
        total, wanted = (0, 0, 0), (-depth, key)
        while True:
            if self.heap and self.heap[0][:2] == wanted:
                row = heapq.heappop(self.heap)
            elif self.runs and self.runs[0][0][:2] == wanted:
                row, _, run = heapq.heappop(self.runs)
                self._next(run)
            else:
                return total
            total = (total[0] + row[2], total[1] + row[3], total[2] + row[4])


_NODE = "node binary, parent binary, conv long, depth long, members long, bytes long, parent_conv long"


def forward(batches: Iterator[pa.RecordBatch], limit: int = QUEUE) -> Iterator[pa.RecordBatch]:
    """Nodes by falling depth, then key, with what is known from below; out come their totals."""
    queue = SpillingQueue(limit)
    for batch in batches:
        totals = []
        columns = [batch[c].to_pylist() for c in ("node", "parent", "depth", "members", "bytes", "top", "children", "leaves", "saved")]
        for node, parent, depth, members, size, top, *known in zip(*columns):
            sent = queue.take(depth, node)
            children, leaves, saved = (a + b for a, b in zip(sent, known))
            leaves = leaves if children else 1
            saved += (members - 1) * size
            if node != top:
                queue.push(depth - 1, parent, 1, leaves, saved)
            totals.append((children, leaves, saved))
        kept = [batch[f.split()[0]] for f in _NODE.split(", ")]
        made = [pa.array([t[i] for t in totals], pa.int64()) for i in range(3)]
        names = [f.split()[0] for f in _NODE.split(", ")]
        is_top = pc.equal(batch["node"], batch["top"])
        yield pa.RecordBatch.from_arrays([*kept, is_top, *made], [*names, "is_top", "children", "leaves", "saved"])


def ends_digest(ends: DataFrame) -> DataFrame:
    """``node, ends_sha256`` of rows ``node, conv``: SHA-256 of the ids in ascending order, joined by commas.

    The ids are sorted over range partitions and become pieces of text there; only the pieces of a node meet, one after the
    other, in the task that hashes them.
    """
    tasks = max(1, int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def pieces(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            nodes, ids = batch["node"], pc.cast(batch["conv"], pa.string()).to_pylist()
            new = pc.not_equal(nodes.slice(1), nodes.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            starts = [0, *(np.flatnonzero(new) + 1).tolist()]
            text = [",".join(ids[a:b]) for a, b in zip(starts, [*starts[1:], n])]
            at = pa.array(starts, pa.int64())
            yield pa.RecordBatch.from_arrays([nodes.take(at), batch["conv"].take(at), pa.array(text)], ["node", "first", "text"])

    def digest(batches):
        current, state = None, None
        for batch in batches:
            done = []
            for node, text in zip(batch["node"].to_pylist(), batch["text"].to_pylist()):
                if node == current:
                    state.update(b",")
                else:
                    if current is not None:
                        done.append((current, state.hexdigest()))
                    current, state = node, hashlib.sha256()
                state.update(text.encode())
            yield _pairs(done)
        if current is not None:
            yield _pairs([(current, state.hexdigest())])

    sorted_ids = ends.repartitionByRange(tasks, "node", "conv").sortWithinPartitions("node", "conv")
    cut = sorted_ids.mapInArrow(pieces, "node binary, first long, text string")
    return cut.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digest, "node binary, ends_sha256 string")


def _pairs(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], ["node", "ends_sha256"]
    )


def _join_small(left: DataFrame, right: DataFrame, on: str, small: bool) -> DataFrame:
    return left.join(F.broadcast(right) if small else right, on, "left")


def trie(sequences: DataFrame, lengths: DataFrame, fan: int = FAN, block: int = BLOCK, queue: int = QUEUE) -> DataFrame:
    """The nodes of the trie of ``sequences`` (``conv, pos, digest, bytes, last``), and the root, with their totals.

    ``lengths`` has ``conv, length`` of every conversation, turnless ones included. Returns, per node: ``conv`` (smallest
    member), ``depth``, ``parent_conv``, ``members``, ``children``, ``leaves``, ``saved``, ``ends_sha256``. Without
    conversations there is no root.
    """
    spark = sequences.sparkSession
    whole = lengths.agg(F.count("*").alias("n"), F.min("conv").alias("least"), F.max("length").alias("longest")).first()
    paths = written(prefixes(sequences, whole["longest"] or 0, block), "paths")
    seen = F.min(F.struct("conv", "pos", "parent", "bytes", "last"))
    nodes = paths.groupBy("node").agg(F.count("*").alias("members"), seen.alias("s"))
    nodes = nodes.select(
        "node", "s.parent", "s.conv", (F.col("s.pos") + 1).alias("depth"), "members", "s.bytes", F.col("s.last").alias("last")
    )
    nodes = written(nodes, "nodes")

    # Classes of the nodes that several conversations share; the root is above all.
    bounds = [fan**k for k in range(1, 64) if fan**k <= max(whole["n"], 1)]
    rank = sum((F.when(F.col("members") >= b, 1).otherwise(0) for b in bounds), F.lit(0)).cast("int")
    top_class = len(bounds) + 1
    root = spark.createDataFrame([(ROOT, top_class, whole["least"])] if whole["n"] else [], "node binary, class int, conv long")
    heavy = nodes.filter(F.col("members") >= fan).select("node", rank.alias("class"), "conv").unionByName(root)
    heavy = written(heavy, "heavy")
    small = is_small(heavy, BROADCAST_ROWS)

    # The smallest member of each parent. A parent that is not heavy has fewer than ``fan`` children.
    known = _join_small(nodes, heavy.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv")), "parent", small)
    light = nodes.filter((F.col("members") < fan)).select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv"))
    found = known.filter("parent_conv is null").drop("parent_conv").join(light, "parent", "left")
    named = written(known.filter("parent_conv is not null").unionByName(found), "named")

    # Shard roots: where a conversation enters a class.
    tops = _join_small(paths, heavy.select("node", "class"), "node", small)
    tops = tops.groupBy("conv", F.coalesce("class", F.lit(0)).alias("class")).agg(F.min(F.struct("pos", "node")).alias("s"))
    shared = named.filter("members > 1").withColumn("class", rank).join(tops.select("conv", "class", F.col("s.node").alias("top")), ["conv", "class"])
    above = root.select("node", F.lit(None).cast("binary").alias("parent"), "conv", F.lit(0).cast("long").alias("depth"))
    above = above.withColumn("members", F.lit(whole["n"]).cast("long")).withColumn("bytes", F.lit(0).cast("long"))
    above = above.withColumn("parent_conv", F.lit(None).cast("long")).withColumn("class", F.lit(top_class)).withColumn("top", F.col("node"))
    shared = written(shared.drop("last").unionByName(above), "shared")

    # What a conversation shares with none is a path: one leaf, nothing saved, one message from its first node.
    own = named.filter("members = 1")
    message = (F.lit(1).cast("long").alias("children"), F.lit(1).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"))
    messages = own.groupBy("conv").agg(F.min(F.struct("depth", "parent")).alias("s")).select(F.col("s.parent").alias("node"), *message)
    children = F.when(F.col("last"), 0).otherwise(1).cast("long").alias("children")
    columns = ["node", "conv", "depth", "parent_conv", "members"]
    result = own.select(*columns, children, message[1], message[2])

    for k in range(top_class + 1):
        sums = messages.groupBy("node").agg(*[F.sum(c).alias(c) for c in ("children", "leaves", "saved")])
        here = shared.filter(F.col("class") == k).join(sums, "node", "left").fillna(0, ["children", "leaves", "saved"])
        here = here.repartition("top").sortWithinPartitions(F.desc("depth"), "node")
        schema = f"{_NODE}, is_top boolean, children long, leaves long, saved long"
        done = written(here.mapInArrow(lambda batches: forward(batches, queue), schema), "totals")
        result = result.unionByName(done.select(*columns, "children", "leaves", "saved"))
        up = done.filter("is_top and parent is not null")
        messages = messages.unionByName(up.select(F.col("parent").alias("node"), message[0], "leaves", "saved"))

    ends = paths.filter("last").select("node", "conv")
    ends = ends.unionByName(lengths.filter("length = 0").select(F.lit(ROOT).alias("node"), "conv"))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    result = result.join(written(ends_digest(ends), "ends"), "node", "left")
    return result.select("conv", "depth", "parent_conv", "members", "children", "leaves", "saved", F.coalesce("ends_sha256", nothing).alias("ends_sha256"))
