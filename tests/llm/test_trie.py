"""The trie of conversations against a plain dictionary of prefixes."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from cartpulse.llm import prefix_trie
from cartpulse.llm.queries import ORACLES, QUERIES
from oracle_check import connect, differences

SCHEMA = "conv_id long, turn long, role string, text string, node string, block int, prior int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)


def by_hand(rows):
    """Nodes as the query returns them, from (conv_id, turn, role, text) in any order."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    convs = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        convs[c] = tuple(own.get(c - c % 5, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[convs[c][:d]].append(c)
    saved, leaves, children = defaultdict(int), defaultdict(int), defaultdict(int)
    for node, its in members.items():
        if node:
            children[node[:-1]] += 1
    for node, its in members.items():
        size = (len(its) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += size
            leaves[node[:d]] += not children[node]
    return sorted((its[0], len(node), members[node[:-1]][0] if node else None, len(its),
                   children[node], leaves[node], saved[node], hashlib.sha256(",".join(
                       str(c) for c in its if convs[c] == node).encode()).hexdigest())
                  for node, its in members.items())


def found(df):
    return sorted(tuple(r[c] for c in (
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", "ends_sha256")) for r in df.collect())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    assert differences(QUERIES["op12_prefix_trie"](spark, sf_dir), connect(sf_dir),
                       ORACLES["op12_prefix_trie"]) == []


@pytest.mark.parametrize("seed", range(3))
def test_random_conversations_against_dictionary(spark, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for c in rng.choice(400, 120, replace=False).tolist():
        for t in range(int(rng.integers(1, 15))):
            rows.append((c, t, "ab"[int(rng.integers(2))], "é" * int(rng.integers(3))))
    rows += [(1000, t, "a", f"{t // 7}") for t in range(100)]
    rows += [(1001, t, "a", f"{t // 7}") for t in range(90)]
    rng.shuffle(rows)
    rows = [(int(c), int(t), str(r), str(x)) for c, t, r, x in rows]
    assert found(prefix_trie.conversation_trie(frame(spark, rows))) == by_hand(rows)


def test_edge_rows(spark, monkeypatch):
    rows = [(1, None, None, None), (1, 0, "u", "hi"), (1, 1, "u", ""), (None, 0, "u", "hi"),
            (2, 0, "", ""), (2, 1, "u", "hi"), (3, 5, "u", "a:b"), (4, 5, "u:", "a b"),
            (6, 0, "u", "x" * 300_000), (7, 0, "u", "x" * 300_000), (10, 3, "u", "hi"),
            (10, 3, "u", "hi")]
    assert found(prefix_trie.conversation_trie(frame(spark, rows))) == by_hand(rows)
    assert prefix_trie.conversation_trie(frame(spark, []).limit(0)).count() == 0
    # turnless after borrowing: the group's first conversation does not exist
    rows = [(c, 0, "u", "hi") for c in range(11, 15)]
    wanted = by_hand(rows)
    assert any(w[1] == 0 and w[7] != hashlib.sha256(b"").hexdigest() for w in wanted)
    assert found(prefix_trie.conversation_trie(frame(spark, rows))) == wanted


def test_many_equal_conversations_in_small_chunks(spark):
    """A node in which very many conversations end; without borrowing."""
    rows = frame(spark, [(c, t, "u", f"{t}") for c in range(700) for t in range(2)])
    node = [r for r in prefix_trie.prefix_trie(
        prefix_trie.whole(prefix_trie.turns(rows))).collect() if r.depth == 2]
    assert len(node) == 1 and node[0].saved_tokens == 699 and node[0].last_bytes == 1
    assert node[0].ends_sha256 == hashlib.sha256(
        ",".join(map(str, range(700))).encode()).hexdigest()


def test_lists_of_ids_go_on_over_chunks(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(prefix_trie, "CHUNK", 10)
    rows = [(b"a", i) for i in range(50)] + [(b"b", i) for i in range(3)]
    parts = [rows[:20], rows[20:21], rows[21:]]
    batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in p]), pa.array([r[1] for r in p])],
                                          ["node", "conv_id"]) for p in parts]
    chunks = list(prefix_trie._listed(iter(batches)))
    assert sum(len(c) for c in chunks) > 10
    digests = {r["node"]: r["ends_sha256"] for b in prefix_trie._hashed(iter(chunks))
               for r in b.to_pylist()}
    assert digests == {k: hashlib.sha256(",".join(str(i) for n, i in rows if n == k).encode())
                       .hexdigest() for k in (b"a", b"b")}
