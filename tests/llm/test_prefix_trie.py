"""The trie against one built in memory."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

from keyfold.llm import prefix_trie
from keyfold.llm.common import workers_find_package

SCHEMA = "conv_id long, turn long, role string, text string, depth int, id string, piece int"


def plain(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            key = hashlib.md5((hashlib.md5((role or "").encode()).hexdigest() + (text or "")).encode()).hexdigest()
            turns[c].append((turn is not None, turn or 0, key, len((text or "").encode()), (role or "", text or "")))
    for c in turns:
        turns[c].sort(key=lambda t: t[:3])
    whole = {}
    for c, own in turns.items():
        h, base = zlib.crc32(str(c).encode()) % 9, c - (abs(c) % 5) * (1 if c >= 0 else -1)
        whole[c] = [(t[4], t[3]) for t in turns.get(base, [])[:h] + own[h:]]
    nodes = defaultdict(list)
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            nodes[tuple(t for t, _ in seq[:d])].append((c, seq[d - 1][1] if d else 0))
    children = defaultdict(list)
    for path in nodes:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(nodes, key=len, reverse=True):
        own = (len(nodes[path]) - 1) * nodes[path][0][1]
        leaves[path] = sum(leaves[x] for x in children[path]) or 1
        saved[path] = own + sum(saved[x] for x in children[path])
    first = {path: min(c for c, _ in members) for path, members in nodes.items()}
    ends = lambda p: ",".join(str(c) for c in sorted(c for c, seq in whole.items() if tuple(t for t, _ in seq) == p))
    return sorted(((first[p], len(p), first[p[:-1]] if p else None, len(nodes[p]), len(children[p]), leaves[p], saved[p],
                    hashlib.sha256(ends(p).encode()).hexdigest()) for p in nodes), key=str)


def both(spark, rows):
    workers_find_package(spark)
    table = spark.createDataFrame([(*r, 1, "x", 9) for r in rows], SCHEMA).repartition(3)
    got = sorted((tuple(r) for r in prefix_trie.trie(table).collect()), key=str)
    assert got == plain(rows)
    return got


def test_random_conversations(spark):
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "bot"]), rng.choice(["hi", "é", "yes " * 3])) for c in range(40) for t in range(rng.choice([1, 2, 5, 14]))]
    got = both(spark, rows)
    assert max(r[3] for r in got) == 40 and max(r[1] for r in got) > 8


def test_awkward_rows(spark):
    rows = [(c, t, "u", f"t{t}") for c in (0, 3, 4, 5, -1, -6, -5) for t in range(12)]
    rows += [(3, None, None, "first"), (3, 4, None, None), (3, 4, "", ""), (3, 4, "", ""), (None, 1, "u", "x"), (11, 0, "u", "alone")]
    rows += [(21, t, "u", "a\0b") for t in (2, 1, None)] + [(22, 1, None, None)]
    rows += [(25, 1, "u", "same")] * 20  # repeated rows
    both(spark, rows)


def test_a_hot_long_conversation_spans_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "ROWS_PER_PIECE", 20)
    rows = [(5, t, "u", f"x{t % 7}") for t in range(400)] + [(c, t, "u", f"x{t % 7}") for c in (6, 7, 25) for t in range(30)]
    both(spark, rows)


def test_many_copies_end_at_one_node(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 50)
    both(spark, [(5 * c, t, "u", f"x{t}") for c in range(80) for t in range(3)])


def test_empty(spark):
    workers_find_package(spark)
    assert prefix_trie.trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "a", "b", 1, "x", 2)], SCHEMA)).collect() == []


def test_contraction(spark):
    """A path, a star, a comb and a random tree, as one forest."""
    n, rng = 60, random.Random(7)
    shapes = [lambda i: i - 1, lambda i: 0, lambda i: rng.randrange(i), lambda i: max(0, i - 1 - i % 2)]
    rows, want = [], {}
    for base, parent in enumerate(shapes):
        up = [None] + [parent(i) for i in range(1, n)]
        depth, weight = [0] * n, [rng.randrange(100) for _ in range(n)]
        for i in range(1, n):
            depth[i] = depth[up[i]] + 1
        total = weight[:]
        for i in reversed(range(1, n)):
            total[up[i]] += total[i]
        name = lambda i: 1000 * base + 7 * i  # noqa: B023, E731
        rows += [(name(i), None if up[i] is None else name(up[i]), depth[i], weight[i]) for i in range(n)]
        want |= {name(i): total[i] for i in range(n)}
    taken: list[int] = []
    tree = spark.createDataFrame(rows, "id long, parent long, depth long, w long")
    assert {r.id: r.w for r in prefix_trie.subtree_sums(tree, ["w"], taken).collect()} == want
    assert len(taken) <= 10  # rounds follow the logarithm, not the depth
