"""The trie against a brute-force version in plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from quern.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, rebuilt=True):
    """Nodes of whole conversations, from what the contract says."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            said = f"{len(role.encode())}:{role}{text}".encode()
            convs[c].append(((turn is not None, turn or 0, hashlib.sha256(said).digest()), (role, text)))
    own = {c: [x for _, x in sorted(v)] for c, v in convs.items()}
    full = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if rebuilt else 0
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        full[c] = (own.get(base, [])[:h] + v[h:]) if rebuilt else v
    nodes = defaultdict(list)
    for c, v in full.items():
        for d in range(len(v) + 1):
            nodes[tuple(v[:d])].append(c)
    children = defaultdict(list)
    for p in nodes:
        if p:
            children[p[:-1]].append(p)
    sums = {}

    def words(t):
        return len([w for w in "".join(" " if ch in "\t\n\x0b\x0c\r" else ch for ch in t).split(" ") if w])

    for p in sorted(nodes, key=len, reverse=True):
        own_sum = (len(nodes[p]) - 1) * (words(p[-1][1]) if p else 0)
        kids = [sums[k] for k in children[p]]
        sums[p] = (sum(k[0] for k in kids) or 1, own_sum + sum(k[1] for k in kids))
    return sorted(
        (min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), len(children[p]), *sums[p], hashlib.sha256(",".join(str(c) for c in sorted(m) if len(full[c]) == len(p)).encode()).hexdigest())
        for p, m in nodes.items()
    )


def trie(spark, rows, block=prefix_trie.BLOCK, extra=()):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in extra:
        df = df.withColumn(name, F.lit("x"))
    c = F.col("conv_id")
    convs, turns = prefix_trie.rebuilt(prefix_trie.turns_of(df), c - c % 20, F.crc32(c.cast("string").cast("binary")) % 4)
    return sorted((tuple(r) for r in prefix_trie.trie(convs, turns, block).drop("node").collect()), key=repr)


def same(got, want):
    assert got == sorted(want, key=repr)


def test_edges(spark):
    """Bases that are absent or short, conversations left without turns, null and negative ids, null turns, roles and texts, ties, repeated rows, copies."""
    rng = random.Random(5)
    rows = []
    for c in [*range(0, 45), 61, 62, 63, -1, -20, -21, -37]:
        for t in range(rng.randrange(1, 3) if c % 20 == 0 else rng.randrange(1, 6)):
            rows.append((c, rng.choice([t, t, None, 1]), rng.choice(["user", "assistant", None]), rng.choice(["a b", "", None, "a b\tc\n", "日本 語"])))
    rows += [(None, 0, "user", "x"), (3, 1, "user", "tie"), (3, 1, "user", "tie"), (3, 1, "user", "other tie"), (5, 9, "user", "long " * 30000)]
    rows += [(c, t, "user", f"copy {t}") for c in range(100, 140) for t in range(5)]  # copies, also of what they borrow
    got = trie(spark, rows, extra=("node", "block", "n", "digest"))
    same(got, brute(rows))
    assert any(r[3] > 5 for r in got[1:])


def test_long_conversations_run_in_blocks(spark):
    """Blocks of four turns; conversations share prefixes that end before, at and behind block ends, and branch again."""
    rng = random.Random(6)
    rows = []
    for c in range(60):
        shared = rng.choice([0, 3, 4, 5, 8, 11, 12])
        rows += [(c, t, "user", f"common {t} " * (t % 3 + 1) if t < shared else f"own {c % 7} {t}") for t in range(rng.randrange(1, 18))]
    same(trie(spark, rows, block=4), brute(rows))
    same(trie(spark, rows), brute(rows))


def test_roles_and_texts_do_not_run_together(spark):
    rows = [(20, 0, "ab", "c"), (40, 0, "a", "bc"), (60, 0, "1:a", "bc")]
    same(trie(spark, rows), brute(rows))


def test_nothing(spark):
    assert trie(spark, []) == []
    assert trie(spark, [(None, 1, "user", "x")]) == []


def test_ids_of_a_node_are_packed_in_order(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PACK", 40)
    members = spark.createDataFrame([(bytes([i % 3]) * 32, c) for i, c in enumerate(random.Random(1).sample(range(-500, 5000), 600))], "node binary, conv_id long")
    want = defaultdict(list)
    for r in members.collect():
        want[bytes(r.node)].append(r.conv_id)
    got = {bytes(r.node): r.ends_sha256 for r in prefix_trie._ends(members.repartition(5)).collect()}
    assert got == {n: hashlib.sha256(",".join(map(str, sorted(v))).encode()).hexdigest() for n, v in want.items()}
