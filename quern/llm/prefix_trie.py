"""Prefix trie of conversations by chained digests.

The digest of a prefix is a hash of the digest before it and of its last turn, so equal digests are equal prefixes. Each conversation is exploded into its
prefixes, and prefixes are grouped by depth and digest into nodes. Sums over subtrees come from nodes exploded to their ancestors.

Three things keep large groups and long conversations apart:

- Chains run in blocks of turns. A block starts from a hash of the blocks before it, so a conversation spreads over as many tasks as it has blocks, and
  only one hash for each block is chained in one place.
- The nodes whose least member is one conversation form the end of its path. Their sums are added up along that path first, so a conversation hands
  one row, not its whole subtree, to each ancestor, and the groups add those up before the shuffle.
- The ids of the conversations that end at a node are sorted over ranges and packed into long strings; a node hashes these strings as they stream by.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.common import in_batches, table, written
from quern.llm.mixing import WORD, words
from quern.operators.running import running

#: Turns of a block.
BLOCK = 512
#: Bytes of a string of packed ids.
PACK = 1 << 16
#: Digest of the root, the prefix without turns.
ROOT = hashlib.sha256(b"").digest()


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, pos, n, digest, words of each turn, in order: by turn, null first; turns of one number by the digest of role and text.

    Texts are hashed and counted where they are read and go no further. Null roles and texts count as empty; rows without conv_id take no part; rows
    that repeat are turns of their own."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)  # the length tells where the role ends
    rows = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.unhex(F.sha2(said, 256)).alias("digest"), words(text).alias("words"))
    return running(rows, ["conv_id"], [F.col("turn"), F.col("digest")], {}, "pos").drop("turn")


def rebuilt(turns: DataFrame, base: Column, first: Column) -> tuple[DataFrame, DataFrame]:
    """conversations (conv_id, n) and turns (conv_id, pos, n, digest, words) in which each conversation begins with the first few turns of another one,
    its base, in place of its own: all of the base's, if it has fewer; none, if there is no such conversation.

    base: the base's id, of conv_id; first: how many turns, of conv_id, at most 3. A conversation may be left without turns."""
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("own")).withColumns({"_base": base, "h": first.cast("long")})
    heads = turns.where("pos < 3").groupBy(F.col("conv_id").alias("_base")).agg(F.array_sort(F.collect_list(F.struct("pos", "digest", "words"))).alias("heads"))  # 3 at most
    given = convs.join(heads, "_base", "left").withColumn("heads", F.coalesce(F.filter("heads", lambda r: r["pos"] < F.col("h")), F.array().cast("array<struct<pos:bigint,digest:binary,words:bigint>>")))
    given = given.withColumn("n", F.size("heads") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).select("conv_id", "h", "heads", "n")
    kept = turns.join(given.select("conv_id", "h", F.size("heads").alias("k"), "n"), "conv_id").where("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "n", "digest", "words")
    borrowed = given.select("conv_id", "n", F.explode("heads").alias("r")).select("conv_id", "r.pos", "n", "r.digest", "r.words")
    return given.select("conv_id", "n"), borrowed.unionByName(kept)


def _onward(start: bytes, turns: bytes) -> bytes:
    """The digest at the end of a whole block, which the next block starts from. turns: the hash of the block's turns."""
    return hashlib.sha256(b"block" + start + turns).digest()


def _chained(block: int):
    """Each turn's prefix digest and its parent's, block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, start, now, turns = None, ROOT, ROOT, hashlib.sha256()
        for batch in batches:
            convs, blocks, places, starts, digests = (batch.column(c).to_pylist() for c in ("conv_id", "block", "pos", "start", "digest"))
            up, out = [], []
            for c, b, p, s, d in zip(convs, blocks, places, starts, digests, strict=True):
                if (c, b) != key:
                    key, start, now, turns = (c, b), s or ROOT, s or ROOT, hashlib.sha256()
                up.append(now)
                turns.update(d.hex().encode())
                now = _onward(start, turns.digest()) if p % block == block - 1 else hashlib.sha256(now + d).digest()
                out.append(now)
            yield pa.record_batch([*(batch.column(c) for c in ("conv_id", "block", "pos", "n", "words")), pa.array(out, pa.binary()), pa.array(up, pa.binary())], ["conv_id", "block", "pos", "n", "words", "node", "parent"])

    return run


def _block_starts(blocks: DataFrame) -> DataFrame:
    """conv_id, block, start of each block but the first: a chain of the digests of the blocks before. One short row a block comes here, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now = None, ROOT
        for batch in batches:
            starts = []
            for c, d in zip(batch.column("conv_id").to_pylist(), batch.column("digest").to_pylist(), strict=True):
                if c != key:
                    key, now = c, ROOT
                now = _onward(now, d)
                starts.append(now)
            ids = batch.column("block").to_pylist()
            yield pa.record_batch([batch.column("conv_id"), pa.array([b + 1 for b in ids], pa.int64()), pa.array(starts, pa.binary())], ["conv_id", "block", "start"])

    dealt = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "block").select("conv_id", "block", "digest")
    return dealt.mapInArrow(run, "conv_id long, block long, start binary")


def prefixes(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id, block, depth, ends, words, node, parent of each prefix of each conversation but the one without turns. turns: conv_id, pos, n, digest, words."""
    rows = turns.withColumn("block", F.floor(F.col("pos") / block).cast("long"))
    full = rows.where(F.col("pos") - F.col("pos") % block + block < F.col("n"))  # blocks that another one follows
    each = F.array_sort(F.collect_list(F.struct("pos", "digest")))  # block turns for each at most
    hashes = full.groupBy("conv_id", "block").agg(F.unhex(F.sha2(F.concat_ws("", F.transform(each, lambda r: F.lower(F.hex(r["digest"])))), 256)).alias("digest"))
    placed = rows.join(_block_starts(hashes), ["conv_id", "block"], "left")
    dealt = placed.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "pos").select("conv_id", "block", "pos", "n", "digest", "words", "start")
    chained = in_batches(dealt).mapInArrow(_chained(block), "conv_id long, block long, pos long, n long, words long, node binary, parent binary")
    return chained.select("conv_id", "block", (F.col("pos") + 1).alias("depth"), (F.col("pos") + 1 == F.col("n")).alias("ends"), "words", "node", "parent")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, first, ids: neighbouring ids of a node as strings of about PACK bytes."""
    out: list[tuple] = []
    node, first, held, size = None, None, [], 0
    for batch in batches:
        for n, c in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if held and (n != node or size > PACK):
                out.append((node, first, ",".join(held)))
                held, size = [], 0
            if not held:
                node, first = n, c
            held.append(str(c))
            size += len(held[-1])
        if out:
            yield _pack_rows(out)
            out = []
    if held:
        yield _pack_rows([(node, first, ",".join(held))])


def _pack_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), (pa.binary(), pa.int64(), pa.string()), strict=True)], ["node", "first", "ids"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, ends_sha256: one hash runs over the strings of a node."""
    node, now = None, None

    def rows(done: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([n for n, _ in done], pa.binary()), pa.array([h for _, h in done])], ["node", "ends_sha256"])

    for batch in batches:
        done = []
        for n, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if n != node:
                if now is not None:
                    done.append((node, now.hexdigest()))
                node, now = n, hashlib.sha256()
            else:
                now.update(b",")
            now.update(ids.encode())
        if done:
            yield rows(done)
    if now is not None:
        yield rows([(node, now.hexdigest())])


def _ends(members: DataFrame) -> DataFrame:
    """node, ends_sha256 of the ids of the conversations that end at each node, in ascending order. members: node, conv_id."""
    sort = members.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    packed = in_batches(sort).mapInArrow(_packed, "node binary, first long, ids string")
    dealt = packed.repartition("node").sortWithinPartitions("node", "first").select("node", "ids")
    return in_batches(dealt).mapInArrow(_hashed, "node binary, ends_sha256 string")


def trie(conversations: DataFrame, turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row for each node: conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and node, its digest.

    conversations: conv_id, n of each conversation, those without turns too; turns: conv_id, pos, n, digest, words, as turns_of() gives them. No
    conversations, no rows."""
    none = F.lit(0).cast("long")
    at_root = conversations.select("conv_id", none.alias("block"), none.alias("depth"), (F.col("n") == 0).alias("ends"), none.alias("words"), F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"))
    paths = written(prefixes(turns, block).unionByName(at_root), "prefixes")
    nodes = written(paths.groupBy("depth", "node", "parent", "words").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")), "nodes")  # parent and words follow from node

    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    counted = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    counted = counted.withColumns({"saved": (F.col("n_convs") - 1) * F.col("words"), "leaf": (F.col("n_children") == 0).cast("long")})
    counted = written(counted, "counted")

    # along each conversation's path: its own nodes' numbers, added up from the end
    own = counted.select("conv_id", "depth", "saved", "leaf")
    weighed = paths.select("conv_id", "block", "depth", "node").join(own, ["conv_id", "depth"], "left").na.fill(0, ["saved", "leaf"])
    later = Window.partitionBy("conv_id", "block").orderBy(F.desc("depth"))
    sums = weighed.withColumns({"saved": F.sum("saved").over(later), "leaf": F.sum("leaf").over(later)})
    blocks = weighed.where("block > 0").groupBy("conv_id", "block").agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"))
    after = Window.partitionBy("conv_id").orderBy(F.desc("block"))  # a row for each block of long conversations
    behind = blocks.select("conv_id", (F.col("block") - 1).alias("block"), F.sum("saved").over(after).alias("saved_behind"), F.sum("leaf").over(after).alias("leaf_behind"))
    both = sums.join(behind, ["conv_id", "block"], "left").na.fill(0, ["saved_behind", "leaf_behind"])
    up = both.select("node", (F.col("saved") + F.col("saved_behind")).alias("saved"), (F.col("leaf") + F.col("leaf_behind")).alias("leaf")).where("saved > 0 OR leaf > 0")
    subtrees = up.groupBy("node").agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))

    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = counted.join(subtrees, "node").join(_ends(paths.where("ends").select("node", "conv_id")), "node", "left").join(parents, "parent", "left")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select(counted["conv_id"], "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nothing).alias("ends_sha256"), "node")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each rebuilt to begin with up to three turns of the one whose id is the next lower multiple of 20."""
    turns = written(turns_of(table(spark, sf_dir, "conversations")), "turns")
    c = F.col("conv_id")
    conversations, rows = rebuilt(turns, c - c % 20, F.crc32(c.cast("string").cast("binary")) % 4)
    return trie(conversations, rows).drop("node")


#: crc32 of the decimal conv_id.
_CRC = (
    "xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),"
    " lambda crc, b: list_reduce(list_prepend(xor(crc, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)))"
)
OP11_SQL = rf"""
WITH t0 AS (SELECT conv_id, turn, sha256(concat(octet_length(encode(coalesce(role, ''))), ':', coalesce(role, ''), coalesce(text, ''))) AS dg,
 CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS words FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, dg) AS pos FROM t0),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, CAST({_CRC} % 4 AS BIGINT) AS h FROM (SELECT DISTINCT conv_id FROM t)),
b AS (SELECT c.conv_id, t.pos, t.dg, t.words FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h),
r AS (SELECT conv_id, pos, dg, words FROM b UNION ALL
 SELECT c.conv_id, t.pos - c.h + (SELECT count(*) FROM b WHERE b.conv_id = c.conv_id), t.dg, t.words FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h),
p AS (SELECT conv_id, CAST(0 AS BIGINT) AS depth, '' AS path, CAST(0 AS BIGINT) AS words FROM c UNION ALL
 SELECT conv_id, CAST(pos AS BIGINT), string_agg(dg, '') OVER (PARTITION BY conv_id ORDER BY pos), words FROM r),
z AS (SELECT *, max(depth) OVER (PARTITION BY conv_id) AS n FROM p),
nodes AS (SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words, sha256(coalesce(string_agg(CASE WHEN n = depth THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256 FROM z GROUP BY ALL),
k AS (SELECT left(path, length(path) - 64) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
f AS (SELECT nodes.*, coalesce(k.n, 0) AS n_children FROM nodes LEFT JOIN k USING (path)),
u AS (SELECT z.path, sum(CAST(f.n_children = 0 AS BIGINT)) AS n_leaves, sum((f.n_convs - 1) * f.words) AS saved FROM f JOIN z ON z.conv_id = f.conv_id AND z.depth <= f.depth GROUP BY ALL)
SELECT f.conv_id, f.depth, up.conv_id AS parent_conv_id, f.n_convs, f.n_children, CAST(u.n_leaves AS BIGINT) AS n_leaves, CAST(u.saved AS BIGINT) AS saved_tokens, f.ends_sha256
FROM f JOIN u USING (path) LEFT JOIN nodes up ON f.depth > 0 AND up.path = left(f.path, length(f.path) - 64)
"""

