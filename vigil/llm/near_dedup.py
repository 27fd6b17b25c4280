"""Near-duplicate documents by HyperMinHash.

Words are lower-cased (A-Z), a document's set holds the hashes of its distinct
five-word shingles. The hash space is cut into ``BUCKETS`` buckets; the smallest
hash in each bucket is kept as a register of its leading-zero count and ten
mantissa bits. Bands of ``ROWS`` registers are join keys. Where J >= 0.85 a band
agrees with chance 0.85**4, so a pair meets in none of the 32 bands with a
chance under 1e-10.

Documents with equal sets are one class first; only classes meet in bands. In a
band's group, members are not paired with each other: a hub (the member that
shares most bands with others) is compared with every member, groups whose
members still lie in different components take another hub. What is open after
``HUB_ROUNDS`` is compared whole: members of groups up to ``SMALL`` pair by
pair; larger groups in cells of two blocks of ``BLOCK`` members, where one
matrix product gives all intersections and only links between different
components leave the task. Large groups of all bands are dealt to cells, and of
those that hold the same members one. So no link between components that meet in
a band is lost, and no row is made per pair of a group. Pairs outside cells pass
the estimate from registers (less the matches by chance) with a margin of several
standard errors first, and all the exact sizes of intersection and union of the
full sets. Components are the smallest doc_id reachable, by label propagation
with pointer jumping.

Defined results: null or wordless text has an empty set, n_shingles 0, and is
linked with nothing; a text of 1 to 4 words is one shingle. Rows that repeat a
doc_id are one node. A null doc_id is linked with nothing and kept. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.text import mix, shingle_hashes, word_hashes, written

SHINGLE = 5
PERCENT = 85           # 100 * intersection >= PERCENT * union
BUCKETS, ROWS = 128, 4
MANTISSA = 10
MARGIN = 0.16          # five standard errors of an estimate from 128 registers at J = 0.85
HUB_ROUNDS = 3
SMALL, BLOCK = 16, 512
COLUMNS = 4096         # of the matrix product at once
ROWS_AT_ONCE, BYTES_AT_ONCE = 512, 1 << 20  # texts whose sets are made at once
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    return np.unique(shingle_hashes(word_hashes((text or "").encode().translate(LOWER)), SHINGLE))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ROWS_AT_ONCE rows and about BYTES_AT_ONCE of text."""
    for batch in batches:
        sizes = pc.binary_length(batch.column("text")).fill_null(0).to_numpy().astype(np.int64)
        part = np.maximum(np.cumsum(sizes) // BYTES_AT_ONCE, np.arange(len(sizes)) // ROWS_AT_ONCE)
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
        yield from (batch.slice(lo, hi - lo) for lo, hi in zip(edges, edges[1:]) if hi > lo)


def registers(shingles: np.ndarray) -> np.ndarray:
    """One uint16 per bucket: leading zeros + 1 and mantissa of the bucket's smallest hash; 0 if it has none."""
    out = np.zeros(BUCKETS, dtype=np.uint16)
    if len(shingles):
        bits = np.uint64(BUCKETS.bit_length() - 1)
        bucket = (shingles >> (np.uint64(64) - bits)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        rest = shingles[first] << bits | np.uint64(1)  # never 0
        zeros = np.uint64(64) - np.frexp((rest >> np.uint64(11)).astype(np.float64))[1].astype(np.uint64) - np.uint64(11)
        zeros = np.minimum(zeros, np.uint64(57))
        mantissa = rest << (zeros + np.uint64(1)) >> np.uint64(64 - MANTISSA)
        out[bucket[first]] = (zeros + np.uint64(1) << np.uint64(MANTISSA)) | mantissa
    return out


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard estimates of register rows, without the matches expected by chance.

    Two unrelated registers have equal leading zeros with chance 1/3 (the sum of 4**-k) and then
    equal mantissas with chance 2**-MANTISSA."""
    used = ((a > 0) | (b > 0)).sum(axis=1)
    equal = ((a == b) & (a > 0)).sum(axis=1)
    chance = 2.0 ** -MANTISSA / 3
    return np.clip((equal / np.maximum(used, 1) - chance) / (1 - chance), 0, 1)


def _signature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in _slices(batches):
        found = []
        for text in part["text"].to_pylist():
            s = shingle_set(text)
            found.append((len(s), xxhash.xxh3_128_digest(s.tobytes()), registers(s).tobytes()))
        sizes, marks, regs = zip(*found)
        marks = np.frombuffer(b"".join(marks), dtype=np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(sizes, pa.int64()), pa.array(marks[:, 0]), pa.array(marks[:, 1]), pa.array(regs, pa.binary())],
                                         ["doc_id", "n_shingles", "h1", "h2", "registers"])


def _band_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bands = BUCKETS // ROWS
    for batch in batches:
        if batch.num_rows:
            regs = np.frombuffer(b"".join(batch["registers"].to_pylist()), dtype=np.uint16).reshape(-1, bands, ROWS)
            key = mix(np.ascontiguousarray(regs).view(np.uint64)[:, :, 0] + np.uint64(1))
            number = np.arange(bands, dtype=np.uint64)  # stays readable in the key's low bits
            key = mix(key + number * np.uint64(0x9E3779B97F4A7C15)) & ~np.uint64(bands - 1) | number
            row, band = np.nonzero((regs > 0).any(axis=2))  # a band without any shingle says nothing
            yield pa.RecordBatch.from_arrays([pa.array(key[row, band].view(np.int64)), batch["node"].take(pa.array(row))], ["band", "node"])


def _likely_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            a, b = (np.frombuffer(b"".join(batch[c].to_pylist()), dtype=np.uint16).reshape(-1, BUCKETS) for c in ("ra", "rb"))
            likely = estimate(a, b) >= PERCENT / 100 - MARGIN
            yield batch.select(["a", "b"]).filter(pa.array(likely))


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in _slices(batches):
        yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array([shingle_set(t).tobytes() for t in part["text"].to_pylist()], pa.binary())], ["node", "shingles"])


def _linked_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        linked = []
        for x, y in zip(batch["sa"].to_pylist(), batch["sb"].to_pylist()):
            x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            linked.append(100 * both >= PERCENT * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))


def _cell_links(cell: pa.Table) -> pa.Table:
    """Links between different components among the members of one cell, enough to connect them."""
    nodes, first = np.unique(cell["node"].to_numpy(), return_index=True)
    cell = cell.take(pa.array(first))
    labels = cell["label"].to_numpy()
    sets = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in cell["shingles"]]
    sizes = np.array([len(x) for x in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    both = np.full((len(sets), len(sets)), float((times == len(sets)).sum()), dtype=np.float64)
    row = np.repeat(np.arange(len(sets)), sizes)
    useful = (times > 1) & (times < len(sets))  # the others are in one set, or in all
    number = np.cumsum(useful) - 1
    row, column = row[useful[column]], number[column[useful[column]]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for lo in range(0, int(useful.sum()), COLUMNS):
        a, b = np.searchsorted(column, (lo, lo + COLUMNS))
        part = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        part[row[a:b], column[a:b] - lo] = 1
        both += part @ part.T
    linked = (100 * both >= PERCENT * (sizes[:, None] + sizes[None, :] - both)) & (labels[:, None] != labels[None, :])
    root = {x: x for x in labels.tolist()}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(np.triu(linked))):
        x, y = find(int(labels[i])), find(int(labels[j]))
        if x != y:
            root[x] = y
            out.append((nodes[i], nodes[j]))
    a, b = zip(*out) if out else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node of ``links`` (a, b) reaches."""
    both = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), "labels")
    while True:
        near = (both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("n")).agg(F.min("label").alias("low")))
        step = labels.join(near, F.col("node") == F.col("n")).select("node", F.col("label").alias("old"), F.least("label", "low").alias("label"))
        up = labels.select(F.col("node").alias("u"), F.col("label").alias("up"))
        step = written(step.join(up, F.col("label") == F.col("u")).select("node", "old", F.least("label", "up").alias("label")), "labels")
        labels = step.drop("old")
        if not step.where("old <> label").limit(1).count():
            return labels


def links(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """(node, label) over the classes ``reps`` (node, n_shingles, registers); nodes without links are absent."""
    bands = written(reps.mapInArrow(_band_batches, "band long, node long"), "bands")
    shared = written(bands.groupBy(F.col("band").alias("key")).agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "shared-bands")
    groups = bands.join(shared, F.col("band") == F.col("key")).drop("key")
    score = groups.groupBy(F.col("node").alias("s")).agg(F.sum("members").alias("score"))
    groups = written(groups.join(score, F.col("node") == F.col("s")).select("band", "node", "score"), "band-groups")
    regs = reps.select("node", "n_shingles", "registers")

    def sets_of(nodes: DataFrame) -> DataFrame:
        wanted = nodes.select(F.col("node").alias("need")).distinct()
        return written(docs.join(wanted, F.col("doc_id") == F.col("need"), "left_semi").mapInArrow(_set_batches, "node long, shingles binary"), "sets")

    def verified(pairs: DataFrame) -> DataFrame:
        a = regs.select(F.col("node").alias("na"), F.col("n_shingles").alias("ca"), F.col("registers").alias("ra"))
        b = regs.select(F.col("node").alias("nb"), F.col("n_shingles").alias("cb"), F.col("registers").alias("rb"))
        near = (pairs.join(a, F.col("a") == F.col("na")).join(b, F.col("b") == F.col("nb"))
                .where((100 * F.col("ca") >= PERCENT * F.col("cb")) & (100 * F.col("cb") >= PERCENT * F.col("ca")))
                .select("a", "b", "ra", "rb").mapInArrow(_likely_batches, "a long, b long"))
        near = written(near, "likely-pairs")
        sets = sets_of(near.select(F.col("a").alias("node")).union(near.select("b")))
        sa = sets.select(F.col("node").alias("na"), F.col("shingles").alias("sa"))
        sb = sets.select(F.col("node").alias("nb"), F.col("shingles").alias("sb"))
        return (near.join(sb, F.col("b") == F.col("nb")).join(sa, F.col("a") == F.col("na")).select("a", "b", "sa", "sb")
                .mapInArrow(_linked_batches, "a long, b long").distinct())

    def cells(members: DataFrame) -> DataFrame:
        """Links inside the groups ``members`` (band, node, label, blocks), each dealt over its pairs of blocks."""
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
        rows = members.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))).withColumn("other", other)
        rows = rows.select("band", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "node", "label")
        sets = sets_of(members).select(F.col("node").alias("ns"), "shingles")
        return (rows.join(sets, F.col("node") == F.col("ns")).groupBy("band", "lo", "hi")
                .applyInArrow(lambda cell: _cell_links(cell), "a long, b long").distinct())

    spark = docs.sparkSession
    found = spark.createDataFrame([], "a long, b long")
    tested = found
    labels = spark.createDataFrame([], "node long, label long")
    for turn in range(HUB_ROUNDS + 1):
        named = labels.select(F.col("node").alias("l"), "label")
        open_ = groups.join(named, F.col("node") == F.col("l"), "left").select("band", "node", "score", F.coalesce("label", "node").alias("label"))
        several = open_.groupBy(F.col("band").alias("key")).agg(
            F.min("label").alias("low"), F.max("label").alias("high"),
            F.max(F.struct("score", "node", "label")).alias("hub")).where("low < high").select("key", "hub")
        open_ = written(open_.join(several, F.col("band") == F.col("key")).drop("key"), "open-groups")
        if turn < HUB_ROUNDS:
            hubs = open_.where(F.col("label") != F.col("hub.label")).select(F.col("hub.node").alias("a"), F.col("node").alias("b"))
        else:  # what is still open, whole
            whole = [F.sum(F.xxhash64(F.lit(k), "node").cast("decimal(20,0)")).alias(f"members{k}") for k in (0, 1)]
            many = written(open_.groupBy(F.col("band").alias("m")).agg(F.count(F.lit(1)).alias("n"), *whole), "open-sizes")
            once = many.where(F.col("n") > SMALL).groupBy("n", "members0", "members1").agg(F.min("m").alias("first")).select("first")
            open_ = written(open_.join(many, F.col("band") == F.col("m")).select("band", "node", "label", "n"), "open-members")
            large = open_.join(once, F.col("band") == F.col("first"), "left_semi").withColumn("blocks", F.ceil(F.col("n") / BLOCK))
            found = found.union(written(cells(large), "cell-links"))
            open_ = open_.where(F.col("n") <= SMALL)
            other = open_.select(F.col("band").alias("o_band"), F.col("node").alias("b"), F.col("label").alias("o_label"))
            hubs = open_.join(other, (F.col("band") == F.col("o_band")) & (F.col("label") != F.col("o_label")) & (F.col("node") < F.col("b"))).select(F.col("node").alias("a"), "b")
        pairs = hubs.distinct().join(tested.select(F.col("a").alias("ta"), F.col("b").alias("tb")),
                                     (F.col("a") == F.col("ta")) & (F.col("b") == F.col("tb")), "left_anti")
        pairs = written(pairs, "pairs")
        more = written(verified(pairs), "verified")
        found = found.union(more)
        tested = tested.union(pairs).union(pairs.select("b", "a"))
        if turn < HUB_ROUNDS:
            # a node that was a hub comes after those that were not; components only grow, so closed groups stay closed
            done = pairs.select(F.col("a").alias("h")).distinct()
            groups = open_.join(done, F.col("node") == F.col("h"), "left").select("band", "node", F.when(F.col("h").isNotNull(), -F.abs("score")).otherwise(F.col("score")).alias("score"))
        if turn == HUB_ROUNDS or more.limit(1).count():
            labels = components(found)
    return labels


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = written(docs.mapInArrow(_signature_batches, "doc_id long, n_shingles long, h1 long, h2 long, registers binary"), "signatures")
    full = signed.where("n_shingles > 0 and doc_id is not null")
    classes = written(full.groupBy("h1", "h2").agg(F.min("doc_id").alias("node"), F.min("n_shingles").alias("n_shingles"), F.min("registers").alias("registers")), "classes")
    labels = links(docs, classes)
    named = labels.select(F.col("node").alias("l"), "label")
    whose = (classes.select("h1", "h2", "node").join(named, F.col("node") == F.col("l"), "left")
             .select(F.col("h1").alias("c1"), F.col("h2").alias("c2"), F.coalesce("label", "node").alias("class_component")))
    rows = signed.select("doc_id", "n_shingles", "h1", "h2").join(whose, (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2")), "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("class_component")).otherwise(F.col("doc_id"))
    return (rows.select("doc_id", "n_shingles", component.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: every pair of documents that share a shingle, on the whole table
ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 85 * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS c FROM r GROUP BY a) m ON d.doc_id = m.a
"""
