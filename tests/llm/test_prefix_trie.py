"""The prefix trie against a brute-force trie."""

import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

KIND = "conv_id long, turn long, role string, text string, nid string, depth int"


def brute(rows):
    """{(conv_id, depth): the other columns} of plain Python tries."""
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))          # as SQL: the sign of c
        built[c] = tuple(own.get(base, [])[:h] + v[h:])
    nodes = {}
    for c, v in built.items():
        for d in range(len(v) + 1):
            nodes.setdefault(v[:d], []).append(c)
    out = {}
    for seq, members in nodes.items():
        below = [s for s in nodes if s[:len(seq)] == seq]
        kids = [s for s in below if len(s) == len(seq) + 1]
        leaves = [s for s in below if not any(len(z) == len(s) + 1 and z[:len(s)] == s for z in below)]
        n_words = lambda s: len(re.findall(r"[^\x20\x09-\x0D]+", s[-1][1])) if s else 0
        saved = sum((len(nodes[s]) - 1) * n_words(s) for s in below)
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(seq))
        out[min(members), len(seq)] = (min(nodes[seq[:-1]]) if seq else None, len(members), len(kids), len(leaves), saved,
                                       hashlib.sha256(ends.encode()).hexdigest())
    return out


def made(spark, rows, **options):
    from marquee.llm.prefix_trie import numbered_turns, prefix_trie, rebuilt
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], KIND).repartition(3)
    got = prefix_trie(rebuilt(numbered_turns(df)), **options).collect()
    keys = [(r.conv_id, r.depth) for r in got]
    assert len(keys) == len(set(keys))
    arcs = sorted(x for r in got for x in (r.enter, r.leave))
    assert arcs == list(range(1, 2 * len(got) + 1))      # the tour's places
    return {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in got}


def sample(seed, n):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(4 * n), n):
        same = rng.random() < 0.3
        for t in range(8 if same else rng.randint(1, 6)):
            rows.append((c, t, rng.choice(["user", "assistant"]) if not same else "user", "one two three" if same else rng.choice(["a", "b c", "", None, "d\te f"])))
    return rows


def test_equals_brute_force(spark):
    rows = sample(1, 120)
    assert made(spark, rows) == brute(rows)


def test_small_blocks_and_random_mates(spark):
    rows = sample(2, 60)
    assert made(spark, rows, block=3, one_task=60) == brute(rows)


def test_edge_rows(spark):
    rows = [(None, 1, "user", "x"), (5, None, None, None), (5, None, None, None), (5, 2, "user", "hello there"), (7, 1, "u", "w " * 5000),
            (20, 1, "u", "w " * 5000), (25, 1, "u", "x"), (-3, 0, "u", "x"), (0, 3, "u", ""), (40, 1, "a", "b"), (40, 2, "a", "b"), (41, 0, "c", None)]
    assert made(spark, rows) == brute(rows)


def test_one_conversation_over_many_partitions(spark):
    rows = [(20, t, "user", f"turn {t}") for t in range(600)] + [(3, t, "user", "x") for t in range(40)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = made(spark, rows, block=16, one_task=40)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got == brute(rows)


def test_empty_table(spark):
    assert made(spark, [], ) == {}


@pytest.mark.parametrize("n", [1, 5])
def test_running_totals(spark, n):
    from marquee.llm.scan import running
    df = spark.range(400).select((F.col("id") % 3).alias("s"), (F.col("id") * 7 % 401).alias("o"), F.col("id").alias("v")).repartition(n)
    rows = running(df, ["s"], ["o"], "test-scan", sums={"sum": "v"}, xors={"xor": "v"}, before={"prev": "v"}).collect()
    for s in range(3):
        total, x, prev = 0, 0, None
        for r in sorted((r for r in rows if r.s == s), key=lambda r: r.o):
            total, x = total + r.v, x ^ r.v
            assert (r.sum, r.xor, r.prev) == (total, x, prev)
            prev = r.v
    assert len(rows) == 400
