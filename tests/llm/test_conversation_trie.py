"""The trie against a plain one built in dictionaries."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskmill.llm import conversation_trie as trie


def plain_trie(rows):
    digest = lambda r: hashlib.md5(f"{len(r[2] or '')}:{r[2] or ''}{r[3] or ''}".encode()).hexdigest()
    own = defaultdict(list)
    for r in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, digest(r))):
        own[r[0]].append((r[2] or "", r[3] or ""))
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 4
        turns = own.get(c - int(math.fmod(c, 20)), [])[:h] + own[c][h:]
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, inside in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(inside) - 1) * words
    sha = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    return sorted(((m[0], len(n), members[n[:-1]][0] if n else None, len(m), children[n], leaves[n], saved[n], sha(ends[n]))
                   for n, m in members.items()), key=repr)


def made(seed):
    rng = random.Random(seed)
    rows = [(c, t if rng.random() < 0.9 else None, rng.choice(["user", None, ""]), rng.choice(["hi there", "HI", None, "", "a\x0bb c\xa0d"]))
            for c in [*range(-25, 30), 40, 45, 61, 99, 10**15] for t in range(rng.randrange(5))]
    rows += [(5, t // 2, "user", f"turn {t % 7}") for t in range(300)]  # one long conversation, each turn twice
    rows += [(c, 0, "user", "same") for c in range(200, 300)] + [(None, 0, "user", "lost"), (310, 1, "x", "w " * 30_000)]
    return rows + rows[:20]


@pytest.mark.parametrize("block,ids", [(8, 4), (1 << 16, 1 << 12)])
def test_equals_plain_trie(spark, monkeypatch, block, ids):
    monkeypatch.setattr(trie, "BLOCK", block)
    monkeypatch.setattr(trie, "IDS", ids)
    rows = made(block)
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, d int").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # many ranges
    try:
        got = sorted((tuple(r) for r in trie.prefix_trie(frame).collect()), key=repr)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == plain_trie(rows)
    assert trie.prefix_trie(frame.limit(0)).count() == 0


def test_contraction_keeps_the_order():
    # a path of nodes (0, 0..n-1) entered downwards and left upwards, dealt to two blocks
    n = 50
    following = [((0, 2 * (d + 1)) if d < n - 1 else (0, 2 * d + 1), (0, 2 * (d - 1) + 1) if d else (-1, -1)) for d in range(n)]
    following = np.array(following).reshape(-1, 2)
    conv, d = np.zeros(n, np.int64), np.arange(n)
    head, offset, tail = trie.contract(conv, d, following)
    assert (head == 0).all() and sorted(offset) == list(range(2 * n)) and tail.sum() == 1
    head, offset, tail = trie.contract(conv[:20], d[:20], following[:40])
    assert set(head) == {0, 39} and tail.sum() == 2 and sorted(offset) == sorted([*range(20)] * 2)


def test_ranks_of_a_long_list(spark):
    links = spark.range(300).select(F.col("id").alias("conv"), F.lit(0).cast("long").alias("ds"), F.when(F.col("id") < 299, F.col("id") + 1).otherwise(-1).alias("next_conv"),
                                    F.when(F.col("id") < 299, 0).otherwise(-1).cast("long").alias("next_ds"), F.lit(1).cast("long").alias("behind"))
    assert {r.conv: r.behind for r in trie.list_ranks(links).collect()} == {i: 300 - i for i in range(300)}
