"""Token-id files: documents compressed one by one with a shared dictionary.

Format: a folder with two tables that Spark's own Parquet writer commits (so a
lost executor leaves no half file, and any file system that Spark reads will do):

* ``dictionary``: one row (dict_hash, dictionary): SHA-256 and bytes of the shared
  zstandard dictionary, trained on little-endian uint32 id arrays.
* ``chunks``: rows (shard, chunk, dict_hash, doc_ids, n_tokens, offsets, frames) in
  ascending doc_id order: ``frames`` joins one zstandard frame per document,
  document k of the chunk is frames[offsets[k]:offsets[k + 1]]. A reader of one
  short document decompresses that frame only.

Each document's ids end with id 0. The dictionary is trained on a bounded
sample: ids of the first ``SAMPLE_CHARS`` characters of the ``SAMPLE`` documents
with the smallest hash of doc_id. All documents are written whole.

Defined results: null text is written as empty (the end id alone). Null doc_ids
come first; rows that repeat a doc_id follow each other, ordered by text. With
too few samples to train on, the samples' bytes are the dictionary; an empty
table has an empty one. Other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.llm.text import give_back, scratch
from vigil.session import settings

TOKENIZER = "byte_bpe_50k.json"
END = 0
TWO_SPACES = re.compile(r"\s\s").search
END_BYTES = END.to_bytes(4, "little")
SAMPLE, SAMPLE_CHARS = 512, 8192
DICTIONARY_BYTES = 65536
LEVEL = 3
CHUNK_DOCS, CHUNK_BYTES = 2048, 2 << 20
BLOCK_CHARS = 2 << 20    # texts encoded at once; a longer text is a block of its own
BLOCK_PIECES = 1 << 18   # pieces whose ids are gathered at once
LEARN = 5_000            # new pieces in one call of the library
BATCH_BYTES = 8 << 20    # of the rows that a task hands to Python at once, and holds twice
CHUNKS = "shard int, chunk int, dict_hash string, doc_ids array<long>, n_tokens array<long>, offsets array<long>, frames binary"


def tokenizer(name: str):
    """The public tokenizer file of that name, or any path."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(name if os.path.isabs(name) else public_tokenizers.path(name))
    t.encode_special_tokens = True  # their strings in a text are ordinary text
    return t


def _runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers start[k] to start[k] + size[k] - 1 of each k, one after another."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


class Encoder:
    """Ids of texts by the tokenizers library, remembered per piece.

    The byte-level pre-tokenizer cuts a text by a fixed pattern, and merges never cross a cut, so the ids
    of a text are those of its pieces. A space after a non-space and before one is always such a cut, so a
    text without white space in a row is cut at its spaces, in Arrow and for many texts at once. The known
    pieces are looked up among the different ones of the texts (so the hash table is as small as those),
    new ones go to the library, and their ids are gathered. The key of a
    piece is what follows its space; a text's first piece has the key "\0" + piece, and "\0\0" is the
    end id. Texts with white space in a row or "\0" go to the library whole. Of more than ``limit`` pieces
    only those are kept that came again since the last such cut."""

    def __init__(self, name: str, limit: int = 600_000):
        self.tokenizer, self.limit = tokenizer(name), limit
        vocabulary = self.tokenizer.get_vocab()
        self.sizes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)  # bytes of each id
        self.sizes[list(vocabulary.values())] = list(map(len, vocabulary))
        self._forget()

    def _forget(self) -> None:
        self.keys = pa.array(["\0\0"], pa.large_string())
        self.ids = np.array([END], dtype="<u4")  # ids of all keys, one after another
        self.ends = np.array([0, 1])
        self.used = np.array([True])             # keys that came again

    def _cut(self) -> None:
        """Keeps the pieces that came again, or none if those are many, too."""
        kept = np.flatnonzero(self.used)
        if len(kept) > self.limit // 2:
            return self._forget()
        size = np.diff(self.ends)[kept]
        self.ids = self.ids[_runs(self.ends[kept], size)]
        self.keys = self.keys.take(pa.array(kept))
        self.ends = np.concatenate(([0], np.cumsum(size)))
        self.used = np.arange(len(kept)) == 0

    def encode(self, text: str | None) -> bytes:
        """Little-endian uint32 ids with the end id."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Of each text, little-endian uint32 ids with the end id."""
        whole = [bool(t) and ("\0" in t or TWO_SPACES(t) is not None) for t in texts]
        plain = iter(self._plain([t or "" for t, w in zip(texts, whole) if not w]))
        return [self._library([t])[0] + END_BYTES if w else next(plain) for t, w in zip(texts, whole)]

    def _plain(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        pieces = pc.split_pattern(pa.array([f"\0{t} \0\0" for t in texts], pa.large_string()), " ")
        at = self._places(pieces.flatten())
        sizes = np.diff(self.ends)[at]
        out = []
        for lo in range(0, len(at), BLOCK_PIECES):
            some, size = at[lo: lo + BLOCK_PIECES], sizes[lo: lo + BLOCK_PIECES]
            out.append(self.ids[_runs(self.ends[some], size)])
        raw = memoryview(np.concatenate(out).tobytes())
        cuts = (np.concatenate(([0], np.cumsum(np.add.reduceat(sizes, pieces.offsets.to_numpy()[:-1])))) * 4).tolist()
        return [bytes(raw[lo:hi]) for lo, hi in zip(cuts, cuts[1:])]

    def _places(self, keys: pa.Array) -> np.ndarray:
        """Places of the keys among the known ones, to which new ones are added."""
        keys = keys.dictionary_encode()
        return self._found(keys.dictionary)[keys.indices.to_numpy()]

    def _found(self, keys: pa.Array, may_cut: bool = True) -> np.ndarray:
        """Places of different keys."""
        at = pc.index_in(self.keys, keys)
        known = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
        places = np.full(len(keys), -1)
        places[at.drop_null().to_numpy()] = known
        new = places < 0
        if new.any():
            if may_cut and len(self.keys) + np.count_nonzero(new) > self.limit:
                self.used[known] = True
                self._cut()
                return self._found(keys, False)
            places[new] = self._learn(keys.filter(pa.array(new)))
        self.used[known] = True
        return places

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, keys: pa.Array) -> np.ndarray:
        """Adds new keys and gives their places. Pieces of a space and a word stay pieces when they are joined, so a call
        encodes ``LEARN`` of them, and their ids are cut at their bytes; first pieces and odd ones go one by one."""
        first = np.array(pc.starts_with(keys, "\0"))
        word = ~first & np.array(pc.greater(pc.binary_length(keys), 0)) & np.array(pc.equal(pc.utf8_trim_whitespace(keys), keys))
        places = np.empty(len(keys), dtype=np.int64)
        known, ids, sizes, count = [self.keys], [self.ids], [], len(self.keys)
        odd = [np.flatnonzero(~word)]
        words = np.flatnonzero(word)
        for lo in range(0, len(words), LEARN):
            some = words[lo: lo + LEARN]
            part = keys.take(pa.array(some))
            joined = pc.binary_join(pa.LargeListArray.from_arrays([0, len(part)], part), pa.scalar(" ", part.type))[0].as_py()
            got = np.array(self.tokenizer.encode_batch_fast([" " + joined], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = np.cumsum(self.sizes[got])
            stops = np.cumsum(np.array(pc.binary_length(part), dtype=np.int64) + 1)
            at = np.searchsorted(ends, stops)
            if ends[-1] != stops[-1] or (ends[at] != stops).any():  # an id runs over a border
                odd.append(some)
                continue
            places[some] = count + np.arange(len(some))
            count += len(some)
            known.append(part)
            ids.append(got)
            sizes.append(np.diff(at, prepend=-1))
        rest = np.concatenate(odd)
        part = keys.take(pa.array(rest))
        raw = self._library([k[1:] if k[:1] == "\0" else " " + k for k in part.to_pylist()])
        places[rest] = count + np.arange(len(rest))
        self.keys = pa.concat_arrays([*known, part])
        self.ids = np.concatenate([*ids, np.frombuffer(b"".join(raw), dtype="<u4")])
        sizes.append(np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)) // 4)
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.concatenate(sizes))])
        self.used = np.concatenate([self.used, np.zeros(len(keys), dtype=bool)])
        return places


@functools.lru_cache(maxsize=1)
def encoder(name: str) -> Encoder:
    """One per process: the tasks of a worker go on with the pieces it knows."""
    return Encoder(name)


def train(samples: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples
        return b"".join(samples)[:DICTIONARY_BYTES]


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """doc_ids and texts, about BLOCK_CHARS characters at a time."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for lo in range(0, batch.num_rows, 64):
            part = batch.slice(lo, 64)
            for doc_id, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist()):
                ids.append(doc_id)
                texts.append(text)
                size += len(text or "")
                if size >= BLOCK_CHARS:
                    yield ids, texts
                    ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def write(docs: DataFrame, path: str, name: str = TOKENIZER) -> None:
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # ids first, so that a task sends SAMPLE numbers to the driver and not as many texts
    ids = docs.select("doc_id").where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE).select(F.col("doc_id").alias("s"))
    sample = (docs.join(F.broadcast(ids), F.col("doc_id") == F.col("s"), "left_semi")  # SAMPLE rows at most
              .select("doc_id", F.substring("text", 1, SAMPLE_CHARS).alias("text")).orderBy("doc_id", "text").limit(SAMPLE).collect())
    dictionary = train([encoder(name).encode(r.text) for r in sample]) if sample else b""
    dict_hash = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(dict_hash, bytearray(dictionary))], "dict_hash string, dictionary binary").write.parquet(f"{path}/dictionary")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = encoder(name).encode_all
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if shared:
            shared.precompute_compress(level=LEVEL)
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)
        shard, chunk = TaskContext.get().partitionId(), 0
        ids, counts, frames = [], [], []

        def flush() -> pa.RecordBatch:
            offsets = np.cumsum([0, *map(len, frames)])
            row = [[shard], [chunk], [dict_hash], [ids], [counts], [offsets], [b"".join(frames)]]
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds)], ["shard", "chunk", "dict_hash", "doc_ids", "n_tokens", "offsets", "frames"])

        size = 0
        for doc_ids, texts in blocks(batches):
            for doc_id, tokens in zip(doc_ids, encode_all(texts)):
                ids.append(doc_id)
                counts.append(len(tokens) // 4)
                frames.append(press.compress(tokens))
                size += len(frames[-1])
                if len(ids) >= CHUNK_DOCS or size >= CHUNK_BYTES:
                    yield flush()
                    chunk, size, ids, counts, frames = chunk + 1, 0, [], [], []
            give_back()
        if ids:
            yield flush()

    with settings(spark, {"spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}):
        (docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
         .mapInArrow(pack, CHUNKS).write.parquet(f"{path}/chunks"))


def read(spark: SparkSession, path: str, doc_ids: list[int] | None = None, with_ids: bool = True) -> DataFrame:
    """doc_id, shard, chunk, before (ids before it in its chunk), n_tokens, ids (uint32 bytes; null without ``with_ids``)
    and ids_crc32, of all or of the given documents."""
    dictionaries = {r.dict_hash: bytes(r.dictionary) for r in spark.read.parquet(f"{path}/dictionary").collect()}  # one row a write
    for h, d in dictionaries.items():
        if hashlib.sha256(d).hexdigest() != h:
            raise ValueError(f"the dictionary of {path} does not have the hash {h}")
    chunks = spark.read.schema(CHUNKS).parquet(f"{path}/chunks")
    wanted = None if doc_ids is None else set(doc_ids)
    if wanted is not None:
        chunks = chunks.where(F.arrays_overlap("doc_ids", F.array(*map(F.lit, doc_ids))))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        openers = {h: zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(d) if d else None) for h, d in dictionaries.items()}
        for batch in batches:
            for row in range(batch.num_rows):
                r = batch.slice(row, 1).to_pylist()[0]
                opener, frames = openers[r["dict_hash"]], memoryview(r["frames"])
                before = np.cumsum([0, *r["n_tokens"]])
                for lo in range(0, len(r["doc_ids"]), 256):
                    ks = [k for k in range(lo, min(lo + 256, len(r["doc_ids"]))) if wanted is None or r["doc_ids"][k] in wanted]
                    raw = [opener.decompress(frames[r["offsets"][k]: r["offsets"][k + 1]]) for k in ks]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r["doc_ids"][k] for k in ks], pa.int64()), pa.array([r["shard"]] * len(ks), pa.int32()),
                         pa.array([r["chunk"]] * len(ks), pa.int32()), pa.array([before[k] for k in ks], pa.int64()),
                         pa.array([r["n_tokens"][k] for k in ks], pa.int64()), pa.array(raw if with_ids else [None] * len(ks), pa.binary()),
                         pa.array([zlib.crc32(x) for x in raw], pa.int64())],
                        ["doc_id", "shard", "chunk", "before", "n_tokens", "ids", "ids_crc32"])

    return chunks.mapInArrow(unpack, "doc_id long, shard int, chunk int, before long, n_tokens long, ids binary, ids_crc32 long")


def documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files."""
    sums = (spark.read.schema(CHUNKS).parquet(f"{path}/chunks")
            .select("shard", "chunk", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda t, x: t + x).alias("n")))
    shards = sums.groupBy(F.col("shard").alias("s")).agg(F.sum("n").alias("total"))  # one row a written partition
    shards = shards.withColumn("shard_start", F.sum("total").over(Window.orderBy("s")) - F.col("total"))
    starts = (sums.withColumn("chunk_start", F.sum("n").over(Window.partitionBy("shard").orderBy("chunk")) - F.col("n"))
              .join(shards, F.col("shard") == F.col("s"))
              .select("s", F.col("chunk").alias("c"), (F.col("shard_start") + F.col("chunk_start")).alias("chunk_start")))
    return (read(spark, path, with_ids=False).drop("ids").join(starts, (F.col("shard") == F.col("s")) & (F.col("chunk") == F.col("c")))
            .select("doc_id", (F.col("chunk_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"))


def tokens(docs: DataFrame) -> DataFrame:
    path = scratch(docs.sparkSession, "token-files")
    write(docs, path)
    return documents(docs.sparkSession, path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
