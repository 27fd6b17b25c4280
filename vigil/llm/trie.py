"""Prefix trie of conversations by a splitter skeleton.

A conversation is a path of turn digests (MD5 of role and text, 16 bytes each),
its nodes are the prefixes of that path. Paths are sorted by (path, conv_id) and
cut into shards at splitters drawn from a hash sample, so the members of a node
are one interval of the order, and a node reaches over a shard's border only if
it is a prefix of the splitter there. The trie of all splitter paths is the
skeleton: its nodes get numbers in preorder and go to all tasks. Each shard is
read once, in order, with a stack of open nodes: all nodes outside the skeleton
are finished there, skeleton nodes yield partial aggregates (and pieces of
their member lists), which are reduced and summed up the skeleton. Splitters
hold the conv_id as well, so that copies of one conversation, however many, are
dealt over shards like anything else.

Bounds: a conversation's path (16 bytes a turn, 4 for its words) is one row;
texts are not moved. The skeleton has at most ``SKELETON`` nodes: longer splitter
paths are cut, so only conversations that agree in more than ``SKELETON`` /
shards turns can't be dealt to several shards. Rows of a shard's open nodes are
held until the parent's smallest member is known, so memory follows the shard.

Defined results: turns are ordered by turn, null first, rows of one turn by the
digest; null roles and texts are empty ones. Rows without a conv_id belong to no
conversation and are left out. Repeated rows are turns like others. An empty
table has no nodes. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.text import words_of, written

DIGEST = 16
HEAD = 4                  # the query's h is below this
BASE = 20                 # the query takes heads from every BASE-th conversation
SHARD_BYTES = 16 << 20    # of paths in a shard
SAMPLE = 32               # sampled paths per shard
SKELETON = 1 << 18        # nodes
ENDS_BYTES = 1 << 20      # of a piece of a member list
LOWEST = -(1 << 63)
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
FOUND = f"kind string, skeleton long, {NODE}, words long, shard int, piece long, ends string"
NAMES = [c.split()[0] for c in FOUND.split(", ")]
TYPES = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}
SCHEMA = pa.schema([(c.split()[0], TYPES[c.split()[1]]) for c in FOUND.split(", ")])


def turns(convs: DataFrame) -> DataFrame:
    """conv_id and its turns in order: array of (digest as hex, words of the text)."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turn = F.struct(F.col("turn"), F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
                    F.size(words_of(text)).alias("words"))
    return (convs.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
            .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
            .select("conv_id", F.transform("t", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("turns")))


def path_of(turns: Column) -> tuple[Column, Column]:
    """Columns path and words of an array of turns."""
    return (F.unhex(F.array_join(F.transform(turns, lambda t: t["digest"]), "")).alias("path"),
            F.transform(turns, lambda t: t["words"]).alias("words"))


def paths(convs: DataFrame) -> DataFrame:
    """conv_id, path and words of every conversation."""
    return turns(convs).select("conv_id", *path_of(F.col("turns")))


def rebuilt_paths(convs: DataFrame) -> DataFrame:
    """``paths`` of conversations whose first turns are those of another: h = crc32(conv_id) % 4 turns of conversation
    conv_id - conv_id % 20, then the own ones behind the first h."""
    own = written(turns(convs), "turns")
    heads = own.where(F.col("conv_id") % BASE == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, HEAD - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % HEAD).cast("int")
    both = own.join(heads, F.col("conv_id") - F.col("conv_id") % BASE == F.col("base"), "left").withColumn("h", h)
    none = F.slice("turns", 1, 0)
    rebuilt = F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")), F.slice("turns", F.col("h") + 1, F.size("turns")))
    return both.withColumn("turns", rebuilt).select("conv_id", *path_of(F.col("turns")))


def common(a: bytes, b: bytes) -> int:
    """Turns that two paths have in common at their start."""
    low, high = 0, min(len(a), len(b)) // DIGEST
    if a[: high * DIGEST] == b[: high * DIGEST]:
        return high
    while high - low > 1:  # a[:low] agrees, a[:high] does not
        mid = (low + high) // 2
        if a[low * DIGEST: mid * DIGEST] == b[low * DIGEST: mid * DIGEST]:
            low = mid
        else:
            high = mid
    return low


class Skeleton:
    """Trie of the splitter paths: ``ids[k][d]`` is the node of the first d turns of splitter k, numbered in preorder."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.splitters = splitters
        self.parent, self.depth = [-1], [0]
        self.ids: list[list[int]] = []
        last, known = b"", [0]
        for path, _ in splitters:
            known = known[: common(last, path) + 1]
            for d in range(len(known), len(path) // DIGEST + 1):
                known.append(len(self.parent))
                self.parent.append(known[d - 1])
                self.depth.append(d)
            self.ids.append([*known])
            last = path

    def around(self, shard: int) -> list[tuple[bytes, list[int]]]:
        """Paths and nodes of the splitters on both sides of a shard."""
        return [(self.splitters[k][0], self.ids[k]) for k in (shard - 1, shard) if 0 <= k < len(self.splitters)]

    def summed(self, rows: dict[int, tuple]) -> list[tuple]:
        """Skeleton nodes from the reduced partial aggregates (conv_id, n_convs, n_children, n_leaves, saved_tokens, words)."""
        if not rows:
            return []
        low, n, children, leaves, saved, words = (list(c) for c in zip(*(rows[i] for i in range(len(self.parent)))))
        for i in range(len(self.parent) - 1, -1, -1):  # children have higher numbers
            saved[i] += (n[i] - 1) * words[i]
            leaves[i] += children[i] == 0
            if i:
                up = self.parent[i]
                children[up] += 1
                leaves[up] += leaves[i]
                saved[up] += saved[i]
        return [(i, low[i], self.depth[i], low[self.parent[i]] if i else None, n[i], children[i], leaves[i], saved[i]) for i in range(len(low))]


class Node:
    __slots__ = ("skeleton", "depth", "low", "before", "children", "leaves", "saved", "words", "ends", "piece", "waiting")

    def __init__(self, skeleton: int | None, depth: int, before: int, words: int):
        self.skeleton, self.depth, self.before, self.words = skeleton, depth, before, words
        self.low, self.children, self.leaves, self.saved, self.piece = None, 0, 0, 0, 0
        self.ends = None          # hash of the member list, or its piece so far
        self.waiting: list = []   # finished children that need this node's smallest member


class Shard:
    """Nodes of the rows of one shard, which come in order."""

    def __init__(self, number: int, skeleton: Skeleton):
        self.number, self.borders, self.rows, self.last, self.out = number, skeleton.around(number), 0, b"", []
        self.open = [Node(0, 0, 0, 0)]

    def add(self, conv_id: int, path: bytes, words: list[int]) -> None:
        shared = common(self.last, path) if self.rows else 0
        while len(self.open) > shared + 1:
            self.close()
        depth = len(path) // DIGEST
        if depth > shared:
            borders = [(common(p, path), ids) for p, ids in self.borders]
            for d in range(shared + 1, depth + 1):
                number = next((ids[d] for reach, ids in borders if d <= reach), None)
                self.open.append(Node(number, d, self.rows, words[d - 1]))
        self.rows, self.last = self.rows + 1, path
        node = self.open[-1]
        if node.low is None or conv_id < node.low:
            node.low = conv_id
        if node.skeleton is None:
            if node.ends is None:
                node.ends = hashlib.sha256(b"%d" % conv_id)
            else:
                node.ends.update(b",%d" % conv_id)
        else:
            node.ends = [] if node.ends is None else node.ends
            node.ends.append(str(conv_id))
            if len(node.ends) * 8 >= ENDS_BYTES:
                self.piece(node)

    def piece(self, node: Node) -> None:
        self.out.append(("ends", node.skeleton, *[None] * 9, self.number, node.piece, ",".join(node.ends)))
        node.ends, node.piece = None, node.piece + 1

    def close(self) -> None:
        node = self.open.pop()
        n = self.rows - node.before
        self.out += [(*r[:4], node.low, *r[5:]) for r in node.waiting]
        up = self.open[-1] if self.open else None
        if up and (up.low is None or node.low < up.low):
            up.low = node.low
        if node.skeleton is not None:
            if node.ends:
                self.piece(node)
            self.out.append(("partial", node.skeleton, node.low, node.depth, None, n, node.children, node.leaves, node.saved, None, node.words, None, None, None))
            return
        leaves, saved = node.leaves or 1, node.saved + (n - 1) * node.words
        row = ("node", up.skeleton, node.low, node.depth, None, n, node.children, leaves, saved, (node.ends or hashlib.sha256()).hexdigest(), *[None] * 4)
        (self.out if up.skeleton is not None else up.waiting).append(row)
        up.children += 1
        up.leaves += leaves
        up.saved += saved

    def finish(self) -> None:
        while self.open:
            self.close()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), SCHEMA)], schema=SCHEMA)


def _shards(skeleton: Skeleton):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                for number, conv_id, path, words in zip(*(part[c].to_pylist() for c in ("shard", "conv_id", "path", "words"))):
                    if shard is None or shard.number != number:
                        if shard:
                            shard.finish()
                            yield _batch(shard.out)
                        shard = Shard(number, skeleton)
                    shard.add(conv_id, path, words)
                    if len(shard.out) >= 10_000:
                        yield _batch(shard.out)
                        shard.out = []
        if shard:
            shard.finish()
            yield _batch(shard.out)

    return run


def _ends_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of each node's member list from its pieces in order."""
    node, seen, out = None, None, []
    for batch in batches:
        for k, text in zip(batch["skeleton"].to_pylist(), batch["ends"].to_pylist()):
            if k != node:
                if node is not None:
                    out.append((node, seen.hexdigest()))
                node, seen = k, hashlib.sha256(text.encode())
            else:
                seen.update(b"," + text.encode())
    if node is not None:
        out.append((node, seen.hexdigest()))
    for lo in range(0, len(out), 10_000):
        k, h = zip(*out[lo: lo + 10_000])
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(h, pa.string())], ["k", "h"])


def trie(paths: DataFrame, shards: int | None = None) -> DataFrame:
    """The nodes of all conversations of ``paths`` (conv_id, path, words), one row each."""
    spark = paths.sparkSession
    paths = written(paths.select("conv_id", "path", "words"), "paths")
    size = paths.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("path")), F.lit(0)).alias("bytes")).first()
    shards = shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size.bytes // SHARD_BYTES))
    limit = max(1, SKELETON // shards)
    hashed = F.pmod(F.xxhash64("conv_id"), F.lit(1 << 30))
    few = paths.where(hashed < int(min(1.0, SAMPLE * shards / max(size.n, 1)) * (1 << 30)))
    sample = sorted((bytes(r.path), r.conv_id if r.turns <= limit else LOWEST)
                    for r in few.select("conv_id", F.substring("path", 1, limit * DIGEST).alias("path"), (F.length("path") / DIGEST).alias("turns")).collect())
    picked = [sample[len(sample) * k // shards] for k in range(1, shards)] if sample else []
    skeleton = Skeleton(sorted(set(picked)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [bisect_right(skeleton.splitters, x) for x in zip(batch["path"].to_pylist(), batch["conv_id"].to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *batch.columns], ["shard", *batch.schema.names])

    dealt = paths.mapInArrow(place, "shard int, conv_id long, path binary, words array<int>")
    ordered = dealt.repartitionById(len(skeleton.splitters) + 1, F.col("shard")).sortWithinPartitions("shard", "path", "conv_id")
    found = written(ordered.mapInArrow(_shards(skeleton), FOUND), "trie")

    reduced = found.where("kind = 'partial'").groupBy("skeleton").agg(
        F.min("conv_id"), F.sum("n_convs"), F.sum("n_children"), F.sum("n_leaves"), F.sum("saved_tokens"), F.max("words"))
    top = skeleton.summed({r[0]: tuple(r)[1:] for r in reduced.collect()})  # at most SKELETON rows
    top = spark.createDataFrame(top, "k long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long")
    pieces = found.where("kind = 'ends'").select("skeleton", "shard", "piece", "ends")
    ends = pieces.repartition("skeleton").sortWithinPartitions("skeleton", "shard", "piece").select("skeleton", "ends").mapInArrow(_ends_batches, "e long, h string")
    top = top.join(ends, F.col("k") == F.col("e"), "left").withColumn("ends_sha256", F.coalesce("h", F.sha2(F.lit(""), 256)))
    names = [c.split()[0] for c in NODE.split(", ")]
    low = top.select("k", F.col("conv_id").alias("low"))
    nodes = found.where("kind = 'node'").join(F.broadcast(low), F.col("skeleton") == F.col("k"), "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "low"))
    return nodes.select(names).union(top.select(names))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(rebuilt_paths(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


#: unsigned crc32 of the decimal conv_id, bit by bit
CRC = """xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint)),
  lambda s, b: list_reduce(list_prepend(xor(s, b), range(8)), lambda c, i: xor(c >> 1, (c & 1) * 3988292384))), 4294967295)"""
ORACLE = rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list({{'d': md5(length(role) || ':' || role || text), 'w': len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))}}
  ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS own FROM t GROUP BY conv_id),
h AS (SELECT *, ({CRC} % 4)::int AS h FROM o),
r AS (SELECT a.conv_id, list_concat(coalesce(b.own, a.own[1:0])[1:a.h], a.own[a.h + 1:]) AS p FROM h a LEFT JOIN o b ON b.conv_id = a.conv_id - a.conv_id % 20),
m AS (SELECT conv_id, len(p) AS n, unnest(range(0, len(p) + 1)) AS depth, p FROM r),
k AS (SELECT conv_id, n, depth, array_to_string(list_transform(p[1:depth], lambda x: x.d), '') AS key,
  CASE WHEN depth > 0 THEN array_to_string(list_transform(p[1:depth - 1], lambda x: x.d), '') END AS up,
  CASE WHEN depth > 0 THEN p[depth].w ELSE 0 END AS w FROM m),
g AS (SELECT key, any_value(up) AS up, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(w) AS own,
  sha256(coalesce(string_agg(conv_id::varchar, ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256 FROM k GROUP BY key, depth),
c AS (SELECT up, count(*) AS n FROM g WHERE depth > 0 GROUP BY up),
s AS (SELECT g.key, g.own, c.n IS NULL AS leaf, substr(g.key, 1, 32 * unnest(range(0, g.depth + 1))) AS above FROM g LEFT JOIN c ON c.up = g.key),
a AS (SELECT above, sum(own)::bigint AS saved_tokens, count(*) FILTER (WHERE leaf) AS n_leaves FROM s GROUP BY above)
SELECT g.conv_id, g.depth, p.conv_id AS parent_conv_id, g.n_convs, coalesce(c.n, 0) AS n_children, a.n_leaves, a.saved_tokens, g.ends_sha256
FROM g JOIN a ON a.above = g.key LEFT JOIN c ON c.up = g.key LEFT JOIN g p ON p.key = g.up
"""
