"""Benchmark decontamination by SimHash over item-sized windows.

The benchmark is a stated query set: it is read in blocks of bounded size, and
each block's index (word-shingle hashes, SimHash fingerprints cut into Hamming
blocks, shingle weights) is broadcast to one pass over all documents. The pass
shuffles nothing.

In a document, only stretches that hold a shingle of an item can hold a window
similar to it, so windows are laid there: one at every word position, as long
as the item (the whole text, if that is shorter). A window's fingerprint is the
SimHash of its shingles. Fingerprints are cut into RADIUS + 1 blocks; two that
differ in at most RADIUS bits agree in a block, so the blocks' tables give all
items in reach. Candidates in reach are verified by the weighted Jaccard
similarity of their shingles, the weight being how often a shingle occurs.

Words are lower-cased (A-Z). Defined results: null or wordless texts and items
match nothing. Items under five words are one shingle. Of several windows the
most similar counts, then the earliest. Repeated documents or items give one
row per (doc_id, item_id); rows with a null id keep it. Other columns pass
through ``clean`` and are ignored elsewhere.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.text import WordHashes, shingle_hashes

SHINGLE = 5
SIMILARITY = 0.8
BITS = 64
RADIUS = 20            # at similarity 0.8 about 10 of 64 bits differ, with a standard deviation of 3
BLOCK_CHARS = 8 << 20  # characters of benchmark text per block
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
STARTS = 32768         # windows fingerprinted at once
#: blocks of 3 or 4 bits: (shift, mask)
CUTS = [(BITS * i // (RADIUS + 1), (1 << (BITS * (i + 1) // (RADIUS + 1) - BITS * i // (RADIUS + 1))) - 1) for i in range(RADIUS + 1)]


def words_hashed(text: str | None, hashes: WordHashes) -> np.ndarray:
    return hashes.of((text or "").encode().translate(LOWER).split())


def fingerprints(shingles: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """SimHash of shingles[s:s + count] for consecutive ``starts``."""
    lo = int(starts[0])
    part = np.ascontiguousarray(shingles[lo: int(starts[-1]) + count])
    bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1)
    sums = np.zeros((len(part) + 1, BITS), dtype=np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    at = starts - lo
    return np.packbits(2 * (sums[at + count] - sums[at]) > count, axis=1).view(np.uint64)[:, 0]


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two (distinct shingles, counts)."""
    _, x, y = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][x], b[1][y]).sum())
    return both / max(1, int(a[1].sum() + b[1].sum()) - both)


class Index:
    """Items of one benchmark block."""

    def __init__(self, items: list[tuple]):
        hashes = WordHashes()
        self.ids, self.bags = [], []
        by_shingle: dict[tuple[int, int], set[int]] = defaultdict(set)  # (k, hash) -> item lengths
        by_size: dict[int, list[int]] = defaultdict(list)
        marks = []
        for item_id, text in items:
            words = words_hashed(text, hashes)
            if not len(words):
                continue
            k = min(SHINGLE, len(words))
            sh = shingle_hashes(words, k)
            by_size[len(words)].append(len(self.ids))
            self.ids.append(item_id)
            self.bags.append(np.unique(sh, return_counts=True))
            marks.append(fingerprints(sh, np.array([0]), len(sh))[0])
            for h in sh.tolist():
                by_shingle[k, h].add(len(words))
        self.tables = {}
        for k in {k for k, _ in by_shingle}:
            keys = np.array(sorted(h for j, h in by_shingle if j == k), dtype=np.uint64)
            seen = np.zeros(1 << 20, dtype=bool)
            seen[(keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
            self.tables[k] = seen, keys, [sorted(by_shingle[k, h]) for h in keys.tolist()]
        self.sizes = {}
        for size, members in by_size.items():
            of = np.array(members)
            fp = np.array([marks[i] for i in members], dtype=np.uint64)
            blocks = [np.arange(mask + 1)[:, None] == (fp >> np.uint64(shift)).astype(np.int64)[None, :] & mask for shift, mask in CUTS]
            self.sizes[size] = of, fp, blocks

    def matches(self, words: np.ndarray) -> dict[int, tuple[float, int, int]]:
        """item index -> (similarity, start, window words) of its best window."""
        best: dict[int, tuple[float, int, int]] = {}
        for k, (seen, keys, lengths) in self.tables.items():
            if len(words) < k:
                continue
            sh = shingle_hashes(words, k)
            at = np.flatnonzero(seen[(sh & np.uint64((1 << 20) - 1)).astype(np.int64)])
            found = np.searchsorted(keys, sh[at])
            hit = (found < len(keys)) & (keys[np.minimum(found, len(keys) - 1)] == sh[at])
            wanted: dict[int, list[int]] = defaultdict(list)
            for place, key in zip(at[hit].tolist(), found[hit].tolist()):
                for size in lengths[key]:
                    wanted[size].append(place)
            for size, places in wanted.items():
                window = min(size, len(words))
                count = window - k + 1
                mark = np.zeros(len(sh) - count + 2, dtype=np.int64)  # starts whose window covers a place
                np.add.at(mark, np.maximum(np.array(places) - count + 1, 0), 1)
                np.add.at(mark, np.minimum(np.array(places) + 1, len(mark) - 1), -1)
                starts = np.flatnonzero(np.cumsum(mark)[:-1] > 0)
                for run in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
                    for lo in range(0, len(run), STARTS):
                        self._search(sh, run[lo: lo + STARTS], count, size, window, best)
        return best

    def _search(self, sh, starts, count, size, window, best) -> None:
        of, fp, blocks = self.sizes[size]
        marks = fingerprints(sh, starts, count)
        near = np.zeros((len(marks), len(of)), dtype=bool)
        for (shift, mask), block in zip(CUTS, blocks):
            near |= block[(marks >> np.uint64(shift)).astype(np.int64) & mask]
        w, i = np.nonzero(near)
        close = np.bitwise_count(marks[w] ^ fp[i]) <= RADIUS
        for row, item in zip(w[close].tolist(), of[i[close]].tolist()):
            start = int(starts[row])
            score = similarity(np.unique(sh[start: start + count], return_counts=True), self.bags[item])
            if score >= SIMILARITY and (item not in best or (-score, start) < (-best[item][0], best[item][1])):
                best[item] = score, start, window


def blocks_of(benchmark: DataFrame, chars: int = BLOCK_CHARS) -> Iterator[Index]:
    """Indexes of bounded size that together hold the whole benchmark."""
    items = benchmark.select("item_id", "text").where("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-2 * total // chars)  # half full on average
    for i in range(n):
        index = Index([tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).collect()])
        if index.ids:
            yield index


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, similarity, start and window (in words): each document's best window for each item it holds."""
    spark = docs.sparkSession
    schema = f"doc_id long, item_id {dict(benchmark.dtypes)['item_id']}, similarity double, start int, window int"
    out = spark.createDataFrame([], schema)
    types = [f.dataType for f in out.schema.fields]
    from pyspark.sql.pandas.types import to_arrow_type
    arrow = [to_arrow_type(t) for t in types]
    for index in blocks_of(benchmark):
        sent = spark.sparkContext.broadcast(index)

        def scan(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            hashes, own = WordHashes(), sent.value
            for batch in batches:
                rows = [(d, own.ids[i], *m) for d, t in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist())
                        for i, m in own.matches(words_hashed(t, hashes)).items()]
                cols = zip(*rows) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, arrow)], ["doc_id", "item_id", "similarity", "start", "window"])

        out = out.union(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, schema))
    order = F.struct("similarity", -F.col("start"))
    return (out.groupBy("doc_id", "item_id").agg(F.max_by(F.struct("similarity", "start", "window"), order).alias("m"))
            .select("doc_id", "item_id", "m.similarity", "m.start", "m.window"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold an item."""
    for index in blocks_of(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def keep(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            hashes = WordHashes()
            for batch in batches:
                yield batch.filter(pa.array([not sent.value.matches(words_hashed(t, hashes)) for t in batch["text"].to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
