"""Prefix trie against plain dictionaries, with classes, blocks and queues made small."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from tests.llm.conftest import SF
from traitloom.llm import prefix_trie
from traitloom.llm.common import table
from traitloom.llm.queries import QUERIES

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own.setdefault(conv, []).append((turn is not None, turn or 0, digest(role, text), (role, text)))
    own = {c: [t[-1] for t in sorted(v)] for c, v in own.items()}
    heads = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    return {c: own.get(c - c % 5, [])[: heads[c]] + v[heads[c] :] for c, v in own.items()}


def brute(sequences):
    members, children, leaves, saved = {}, {}, {}, {}
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    for path in members:
        if path:
            children[path[:-1]] = children.get(path[:-1], 0) + 1
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = leaves.get(path, 0) or 1
        saved[path] = saved.get(path, 0) + ((len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0)
        if path:
            leaves[path[:-1]] = leaves.get(path[:-1], 0) + leaves[path]
            saved[path[:-1]] = saved.get(path[:-1], 0) + saved[path]
    out = []
    for path, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(sequences[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        sums = (len(convs), children.get(path, 0), leaves[path], saved[path])
        out.append((min(convs), len(path), parent, *sums, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed=7):
    rnd = random.Random(seed)
    rows = []
    for conv in range(160):
        # Every third conversation starts alike, some are long, copies of long ones included.
        n = 75 if conv % 40 < 3 else rnd.randrange(1, 14)
        for turn in range(n):
            words = "same" if conv % 3 == 0 and turn < 4 or n == 75 and turn < 70 else rnd.choice("abé")
            rows.append((conv, turn, rnd.choice(["user", "bot"]) if words != "same" else "user", words * (turn % 5 + 1)))
    rows += [(200, None, None, None), (200, 0, "user", "x"), (200, 0, "user", "x"), (200, 0, "user", "y"), (None, 0, "user", "lost")]
    rows += [(7, None, "user", ""), (205, 1, "", "z" * 50_000), (206, 1, None, "z" * 50_000)]
    rnd.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def sequences(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA + "").repartition(5)
    return rows, *prefix_trie.rebuilt(prefix_trie.turns(df))


@pytest.mark.parametrize(("fan", "block", "queue"), [(2, 2, 1), (3, 4, 5), (10, 8, 1000), (prefix_trie.FAN, prefix_trie.BLOCK, 10)])
def test_totals_in_any_classes_blocks_and_queues(sequences, fan, block, queue):
    rows, turns, lengths = sequences
    names = ["conv", "depth", "parent_conv", "members", "children", "leaves", "saved", "ends_sha256"]
    got = [tuple(r) for r in prefix_trie.trie(turns, lengths, fan, block, queue).select(*names).collect()]
    assert sorted(got, key=str) == brute(rebuilt(rows))


def test_query_on_the_driver_table(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").collect()]
    got = [tuple(r) for r in QUERIES["op12_prefix_trie"](spark, SF).select(*COLUMNS).collect()]
    assert sorted(got, key=str) == brute(rebuilt(rows))


def test_turnless_conversations_end_at_the_root(spark, tmp_path):
    # With a head at least as long as the conversation and no first of the group, nothing is left.
    ids = [c for c in range(1, 400) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2][:20]
    rows = [(c, t, "user", "hello") for c in ids for t in range(2)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = [tuple(r) for r in QUERIES["op12_prefix_trie"](spark, str(tmp_path)).select(*COLUMNS).collect()]
    assert got == brute(rebuilt(rows)) and len(got) == 1


def test_a_conversation_over_many_tasks_is_numbered_through(spark):
    rows = [(1, t, "user", f"t{t}") for t in range(5_000)] + [(2, 0, "user", "a")]
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        placed = prefix_trie.turns(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    order = {digest("user", f"t{t}")[:16]: t for t in range(5_000)}
    assert all(r["pos"] == order[bytes(r["digest"])] for r in placed if r["conv"] == 1)
    assert sorted(r["pos"] for r in placed) == [0, *range(5_000)]


def test_queue_hands_out_in_order_whatever_was_spilled():
    rnd = random.Random(4)
    keys = [bytes([rnd.randrange(256) for _ in range(16)]) for _ in range(40)]
    sent = [(rnd.randrange(1, 6), rnd.choice(keys), rnd.randrange(9), rnd.randrange(9), rnd.randrange(1 << 40)) for _ in range(900)]
    queue = prefix_trie.SpillingQueue(limit=25, most_runs=4)
    for message in sent:
        queue.push(*message)
    assert queue.spilled > 10
    for depth, key in sorted({m[:2] for m in sent}, key=lambda m: (-m[0], m[1])):
        mine = [m[2:] for m in sent if m[:2] == (depth, key)]
        assert queue.take(depth, key) == tuple(map(sum, zip(*mine)))


def test_clashing_columns(spark, tmp_path):
    rows = [(c, t, "user", "x", 1, "n", 2.0) for c in range(12) for t in range(4)]
    schema = SCHEMA + ", pos int, node string, conv double"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/conversations.parquet")
    got = [tuple(r) for r in QUERIES["op12_prefix_trie"](spark, str(tmp_path)).select(*COLUMNS).collect()]
    assert sorted(got, key=str) == brute(rebuilt([r[:4] for r in rows]))
