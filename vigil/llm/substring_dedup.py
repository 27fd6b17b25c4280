"""Removal of passages that repeat across documents, with FM-indexes over shards.

A window is 20 consecutive words. Each window belongs to the smallest hash of
its six-word runs (its minimizer); consecutive windows with one minimizer make
a segment. Equal windows have equal minimizers, so all occurrences of a window
meet where segments are grouped by minimizer, and a segment whose minimizer
occurs once in the corpus is done.

Segments of equal content are one class before anything is gathered: its first
member stands for all, every later member repeats it. Classes that share a
minimizer with other classes are dealt over shards by minimizer. A shard builds
a compressed FM-index of its classes' words and streams the same classes
through backward search; runs whose matching statistic reaches 20 words are
reported as intervals, all but the earliest occurrence.

A minimizer with more than ``HOT`` classes (a short phrase that a large part of
the corpus holds in different contexts) would make one shard grow without
bound. Its classes are cut into single windows, which are aggregated by content
instead; the result is the same.

Defined results: null text counts as empty: 0 words, nothing removed, the hash
of the empty string. Texts under 20 words keep all words. Null doc_id comes
before all others. Rows that repeat a doc_id with the same text are one
document (each row gets its result); with different texts they are ordered by
a hash of the text. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.fm_index import FMIndex
from vigil.llm.text import mix, word_hashes, written

WINDOW = 20
RUN = 6         # words in a minimizer
HOT = 256       # classes of one minimizer beyond which they are cut into windows
SHARD_WORDS = 2_000_000
_R = 0x9E3779B97F4A7C15
_R_INV = pow(_R, -1, 1 << 64)


class Rolling:
    """Hashes of any runs of a word-hash array from prefix sums of a polynomial modulo 2**64."""

    power = back = np.ones(1, dtype=np.uint64)

    def __init__(self, words: np.ndarray):
        n = len(words)
        if len(Rolling.power) <= n:  # tables of powers, made once per worker for the longest text so far
            size = 2 * n + 1024
            for name, base in (("power", _R), ("back", _R_INV)):
                factors = np.full(size, base, dtype=np.uint64)
                factors[0] = 1
                setattr(Rolling, name, np.cumprod(factors, dtype=np.uint64))
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(words * Rolling.power[:n], dtype=np.uint64, out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * Rolling.back[start] + (stop - start).astype(np.uint64))


def segments(words: np.ndarray, window: int = WINDOW, run: int = RUN) -> tuple[np.ndarray, ...]:
    """(minimizer, content hash, first window, windows) of each segment of one document."""
    n = len(words) - window + 1
    if n <= 0:
        none = np.zeros(0, dtype=np.uint64)
        return none, none, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    rolling = Rolling(words)
    at = np.arange(len(words) - run + 1)
    runs = rolling.of(at, at + run)
    place = np.lib.stride_tricks.sliding_window_view(runs, window - run + 1).argmin(axis=1) + np.arange(n)
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    count = np.diff(np.concatenate((first, [n])))
    return runs[place[first]], rolling.of(first, first + count + window - 1), first, count


def tag_of(text: bytes) -> int:
    """Tells rows apart that share a doc_id."""
    return xxhash.xxh32_intdigest(text) >> 1


def _segment_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            out: list[list] = [[], [], [], [], [], []]
            for doc_id, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist()):
                raw = (text or "").encode()
                m, h, first, count = segments(word_hashes(raw))
                for column, values in zip(out, (m.view(np.int64), h.view(np.int64), first.astype(np.int32), count.astype(np.int32))):
                    column.append(values)
                out[4].append(pa.array([doc_id] * len(m), pa.int64()))
                out[5].append(np.full(len(m), tag_of(raw), dtype=np.int32))
            ids = pa.concat_arrays(out[4])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(out[0])), pa.array(np.concatenate(out[1])), ids, pa.array(np.concatenate(out[5])),
                 pa.array(np.concatenate(out[2])), pa.array(np.concatenate(out[3]))], ["m", "h", "doc_id", "tag", "at", "n"])


def _packed_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    zip_ = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        raw = [(t or "").encode() for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array([tag_of(r) for r in raw], pa.int32()),
                                          pa.array([zip_.compress(r) for r in raw], pa.binary())], ["doc_id", "tag", "packed"])


def _unpack(packed: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(packed).split()


def _piece_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the wanted segments: one piece per segment, or per window where the minimizer is hot."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 64):
            rows: list[tuple] = []
            for row in batch.slice(lo, 64).to_pylist():
                words = word_hashes(zstandard.ZstdDecompressor().decompress(row["packed"]))
                rolling = Rolling(words) if any(seg["hot"] for seg in row["wanted"]) else None
                for seg in row["wanted"]:
                    if seg["hot"]:
                        at = np.arange(seg["at"], seg["at"] + seg["n"])
                        rows += [(k, True, row["doc_id"], row["tag"], a, None) for k, a in zip(rolling.of(at, at + WINDOW).view(np.int64).tolist(), at.tolist())]
                    else:
                        rows.append((seg["m"], False, row["doc_id"], row["tag"], seg["at"],
                                     words[seg["at"]: seg["at"] + seg["n"] + WINDOW - 1].view(np.int64)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
                    pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64())))],
                    ["key", "hot", "doc_id", "tag", "at", "words"])


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One partition is one shard: index its pieces, stream them through, report repeated intervals."""
    some = [b for b in batches if b.num_rows]
    if not some:
        return
    table = pa.Table.from_batches(some)
    table = table.sort_by([("doc_id", "ascending"), ("tag", "ascending"), ("at", "ascending")])  # null doc_id: see below
    ids = table["doc_id"].combine_chunks()
    null = ids.is_null().to_numpy(zero_copy_only=False)
    keys = np.stack([ids.fill_null(0).to_numpy(), null, table["tag"].to_numpy(), table["at"].to_numpy()])
    new = np.concatenate(([True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)))  # repeated rows bring their pieces twice
    order = np.flatnonzero(new)
    order = order[np.argsort(~null[order], kind="stable")]  # null doc_id first
    lists = table["words"].combine_chunks().take(pa.array(order))
    sizes = np.diff(lists.offsets.to_numpy())
    flat = np.unique(lists.flatten().to_numpy(), return_inverse=True)[1] + 1
    ends = np.cumsum(sizes + 1)
    begins = ends - sizes - 1
    text = np.zeros(int(ends[-1]), dtype=np.int64)
    inside = np.ones(len(text), dtype=bool)
    inside[ends - 1] = False
    text[inside] = flat
    windows = sizes - WINDOW + 1
    piece = np.repeat(np.arange(len(sizes)), windows)
    starts = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows) + begins[piece]
    of = np.zeros(len(text), dtype=np.int64)
    of[starts] = piece
    found, low = FMIndex(text).repeated(text, starts, WINDOW)
    by = np.lexsort((found, low))
    again = np.concatenate(([False], low[by][1:] == low[by][:-1])) if len(by) else np.zeros(0, dtype=bool)
    later = np.sort(found[by][again])  # all but the earliest of each window
    if not len(later):
        return
    split = np.flatnonzero(np.concatenate(([True], (np.diff(later) > 1) | (np.diff(of[later]) > 0))))
    first, last = later[split], later[np.concatenate((split[1:] - 1, [len(later) - 1]))]
    where = order[of[first]]
    at = table["at"].to_numpy()[where] + (first - begins[of[first]])
    rows = pa.array(where)
    yield pa.RecordBatch.from_arrays([ids.take(rows), table["tag"].combine_chunks().take(rows), pa.array(at.astype(np.int32)),
                                      pa.array((at + (last - first) + WINDOW).astype(np.int32))], ["doc_id", "tag", "start", "stop"])


def _result_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, packed, spans in zip(batch["doc_id"].to_pylist(), batch["packed"].to_pylist(), batch["spans"].to_pylist()):
            words = _unpack(packed)
            kept, end = [], 0
            for span in sorted(spans or (), key=lambda s: s["start"]):
                kept += words[end: span["start"]]
                end = max(end, span["stop"])
            kept += words[end:]
            rows.append((doc_id, len(words), len(words) - len(kept), b" ".join(kept)))
        ids, n, gone, texts = zip(*rows) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                                          pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                                          pa.array([t.decode() for t in texts], pa.string())],
                                         ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, tag, start, stop): word spans to remove; spans of one document may overlap."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = written(docs.mapInArrow(_segment_batches, "m long, h long, doc_id long, tag int, at int, n int"), "segments")
    often = found.groupBy("m").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select(F.col("m").alias("often"))
    often = written(often, "repeated-minimizers")  # a plain table, so that a skewed side of the join can be split
    found = written(found.join(often, F.col("m") == F.col("often")).drop("often"), "repeated-segments")
    classes = found.groupBy("m", "h").agg(F.min(F.struct("doc_id", "tag", "at")).alias("first"), F.min("n").alias("n"))
    classes = written(classes, "segment-classes")
    later = (found.join(classes.select(F.col("m").alias("cm"), F.col("h").alias("ch"), "first"), (F.col("m") == F.col("cm")) & (F.col("h") == F.col("ch")))
             .where(~F.struct("doc_id", "tag", "at").eqNullSafe(F.col("first")))
             .select("doc_id", "tag", F.col("at").alias("start"), (F.col("at") + F.col("n") + WINDOW - 1).alias("stop")))
    mixed = classes.groupBy(F.col("m").alias("mixed")).agg(F.count(F.lit(1)).alias("classes")).where("classes > 1")
    mixed = written(mixed, "mixed-minimizers")
    wanted = (classes.join(mixed, F.col("m") == F.col("mixed"))
              .groupBy("first.doc_id", "first.tag")  # at most the document's own segments
              .agg(F.collect_list(F.struct(F.col("first.at").alias("at"), "n", "m", (F.col("classes") > HOT).alias("hot"))).alias("wanted"))
              .select(F.col("doc_id").alias("w_doc"), F.col("tag").alias("w_tag"), "wanted"))
    packed = docs.mapInArrow(_packed_batches, "doc_id long, tag int, packed binary")
    pieces = (packed.join(wanted, F.col("doc_id").eqNullSafe(F.col("w_doc")) & (F.col("tag") == F.col("w_tag")))
              .mapInArrow(_piece_batches, "key long, hot boolean, doc_id long, tag int, at int, words array<long>"))
    pieces = written(pieces, "segment-pieces")
    cold = pieces.where("not hot")
    shards = max(1, -(-(cold.agg(F.sum(F.size("words"))).first()[0] or 0) // SHARD_WORDS))
    shards = max(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    searched = cold.repartition(shards, "key").mapInArrow(_shard, "doc_id long, tag int, start int, stop int")
    hot = pieces.where("hot").select("key", "doc_id", "tag", "at")
    first = hot.groupBy(F.col("key").alias("f_key")).agg(F.min(F.struct("doc_id", "tag", "at")).alias("first"))
    cut = (hot.join(first, F.col("key") == F.col("f_key")).where(~F.struct("doc_id", "tag", "at").eqNullSafe(F.col("first")))
           .select("doc_id", "tag", F.col("at").alias("start"), (F.col("at") + WINDOW).alias("stop")))
    return later.unionByName(searched).unionByName(cut)


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept_text of every document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spans = (repeated_spans(docs).groupBy(F.col("doc_id").alias("s_doc"), F.col("tag").alias("s_tag"))
             .agg(F.collect_set(F.struct("start", "stop")).alias("spans")))  # at most one per window of the document
    packed = docs.mapInArrow(_packed_batches, "doc_id long, tag int, packed binary")
    return (packed.join(spans, F.col("doc_id").eqNullSafe(F.col("s_doc")) & (F.col("tag") == F.col("s_tag")), "left")
            .select("doc_id", "packed", "spans")
            .mapInArrow(_result_batches, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return dedup(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


#: every pair of equal windows found by grouping, on the whole table
ORACLE = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
gone AS (SELECT doc_id, list(DISTINCT p) AS p FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM again) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(len(p), 0) AS n_removed,
  sha256(coalesce(array_to_string(list_filter(w, lambda x, i: NOT list_contains(coalesce(p, []), i)), ' '), '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
"""
