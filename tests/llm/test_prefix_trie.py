"""The prefix trie against one built in memory: real, hot, long and hard conversations."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from winback.llm import prefix_trie as p

SCHEMA = "conv_id long, turn long, role string, text string, depth string, xa string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        path = tuple(own.get(c - c % 100, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
            if d:
                children[path[:d - 1]].add(path[:d])
        ends[path].append(c)
    total = {}
    for path in sorted(members, key=len, reverse=True):
        kids = [total[k] for k in children[path]]
        total[path] = (sum(k[0] for k in kids) or 1,
                       sum(k[1] for k in kids) + (len(path[-1][1]) * (len(members[path]) - 1) if path else 0))
    return [(members[s][0], len(s), members[s[:-1]][0] if s else None, len(members[s]), len(children[s]), *total[s],
             hashlib.sha256(",".join(map(str, ends[s])).encode()).hexdigest()) for s in members]


def same(spark, rows, **kw):
    d = spark.createDataFrame([(*r, "clash", None) for r in rows], SCHEMA)
    got = p.trie(d, **kw)
    assert got.columns == NAMES
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, brute(rows)))


@pytest.mark.parametrize("cap", [None, 3])
def test_real_conversations(spark, sf_dir, cap):
    d = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in d.collect()]
    assert sorted(map(str, map(tuple, p.trie(d, cap=cap).collect()))) == sorted(map(str, brute(rows)))


def test_hot_turns_and_a_long_conversation(spark):
    r = random.Random(5)
    rows = [(7, t, "user", f"w{t % 3}") for t in range(3000)]             # over many blocks, a third of all rows
    for c in range(100, 900):
        n = r.randrange(1, 9)
        rows += [(c, t, "user" if t % 2 else "system", "same" if r.random() < 0.8 else r.choice("ab")) for t in range(n)]
    rows += [(c, t, "user", f"w{t % 3}") for c in (8, 1000, 2000) for t in range(r.randrange(500, 2500))]
    r.shuffle(rows)
    same(spark, rows, cap=20, block=64)
    same(spark, rows)


def test_hard_rows(spark):
    rows = [(None, 1, "user", "x"), (100, None, None, None), (100, None, None, None), (100, 3, "", "late"),
            (100, 2, "user", "b"), (100, 2, "user", "a"), (100, 2, "assistant", "c"), (101, None, "user", "é日本"),
            (105, 1, "user", "x"), (105, 1, "user", "x"), (250, 9, None, "only"), (251, 1, "u", None), (0, 0, "u", "y" * 100_000),
            (0, 1, "u", "y" * 100_000 + "z"), (3, 0, "u", ""), (3, 1, None, ""), (9, 5, "u", "t" * 80 + "b"), (9, 5, "u", "t" * 80 + "b")]
    same(spark, rows)
    same(spark, rows, cap=1, block=1)
    turnless = [(c, 0, "u", "t") for c in range(1100, 1200)]
    same(spark, turnless)
    same(spark, [])


def test_queue_spills(spark):
    r = random.Random(1)
    q, kept = p.SpillingQueue(limit=50), []
    for i in range(2000):
        kept.append((r.randrange(100), r.randrange(9), i))
        q.push(kept[-1])
        if r.random() < 0.3:
            kept.sort()
            assert q.first() == kept[0] and q.pop() == kept.pop(0)
    kept.sort()
    assert q.spilled > 10 and [q.pop() for _ in kept] == kept and q.first() is None
