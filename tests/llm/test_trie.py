"""The prefix trie against a plain recursion over dictionaries."""

import hashlib
import random
import zlib

import pytest

from millrace.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, place bigint, said string, size bigint, node string, shard string"


def brute(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in turns.items()}
    made = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        made[c] = tuple(turns.get(base, [])[:h] + own[h:])
    members = {}
    for c, said in made.items():
        for d in range(len(said) + 1):
            members.setdefault(said[:d], []).append(c)
    below = {}
    for key in members:
        if key:
            below.setdefault(key[:-1], []).append(key)
    total = {}
    for key in sorted(members, key=len, reverse=True):
        kids = below.get(key, [])
        own = (len(members[key]) - 1) * len(key[-1][1]) if key else 0
        total[key] = (sum(total[k][0] for k in kids) or 1, own + sum(total[k][1] for k in kids))
    out = []
    for key, who in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in who if made[c] == key))
        up = min(members[key[:-1]]) if key else None
        out.append((min(who), len(key), up, len(who), len(below.get(key, [])), *total[key], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def trie(spark, rows, parts=3, **options):
    df = spark.createDataFrame([(*r, 0, "x", 0, "x", "x") for r in rows], SCHEMA).repartition(parts)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(prefix_trie.rebuilt(df), **options).select(*columns).collect()), key=repr)


def talks(seed, n, words=3, most=9):
    r = random.Random(seed)
    return [(c, t, r.choice(["user", "assistant"]), r.choice(["a", "bé", "long text"][:words])) for c in range(n) for t in range(r.randrange(most))]


@pytest.mark.parametrize("members", [1, 4, 1000])
def test_random_talks(spark, members):
    """Shards of one conversation, of a few, and one shard for all."""
    rows = talks(1, 150, 2)
    assert trie(spark, rows, shard_members=members) == brute(rows)


def test_spilling_queue_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "ENDS_CHUNK", 3)
    rows = talks(2, 120, 1) + [(c, t, "user", "copy") for c in range(200, 260) for t in range(4)]
    assert trie(spark, rows, shard_members=1000, queue_items=2) == brute(rows)


def test_one_long_talk_and_its_copies(spark):
    rows = [(c, t, "user", f"{t}") for c in (500, 501, 502, 707) for t in range(300)] + talks(3, 30)
    assert trie(spark, rows, shard_members=2) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "lost"), (1, None, "user", "first"), (1, 0, None, None), (1, 0, None, None), (1, 0, "", ""), (1, 5, "user", "x" * 100_000),
        (100, 0, "user", "hi"), (103, 0, "user", "hi"), (104, 0, "user", "hi"), (-7, 0, "user", "hi"), (-107, 0, "u", "hi"), (-100, 3, "u", "hi"), (0, 0, "user:", "hi"),
        (2, 0, "us", "er"), (3, 0, "user", ""), (3, 1, "", "user"), (2**62, 0, "user", "far"), (2**62, None, "user", "far"),
        *[(900 + i, t, "user", "same") for i in range(40) for t in range(7)],
    ]
    got = trie(spark, rows)
    assert got == brute(rows)
    assert [r for r in got if r[1] == 0][0][3] == len({r[0] for r in rows} - {None})


def test_empty_and_turnless(spark):
    assert trie(spark, []) == []
    assert trie(spark, [(None, 0, "user", "lost")]) == []
    alone = [(c, 0, "user", "hi") for c in (13, 14, 15, 16)]
    assert trie(spark, alone) == brute(alone)


def test_queue_orders_what_it_spills():
    r, queue = random.Random(5), prefix_trie.SpillingQueue(7)
    items = [(r.randrange(-20, 0), r.randrange(5), 1, i, i * i) for i in range(500)]
    for item in items:
        queue.push(item)
    got = [x for key in sorted({i[:3] for i in items}) for x in queue.take(key)]
    assert sorted(got) == sorted(items) and [x[:3] for x in got] == sorted(i[:3] for i in items) and not queue
    assert len(queue.runs) > 40
