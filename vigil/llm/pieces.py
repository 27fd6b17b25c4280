"""SentencePiece BPE: ids of whole texts by vectorised merge rounds, and texts of ids.

The normaliser of the model family served here is the identity with a dummy
prefix: a text gets a space in front and spaces are written as U+2581. No piece
of the vocabulary holds that sign after another character, nor certain
characters next to any other, so merges never cross these borders: texts are cut
there into words, and each distinct word of a block of texts is encoded once.

All words of a block lie in one flat array of symbols. A round finds the best
(lowest) pair rank of every word by a segmented minimum, merges its leftmost
pairs of that rank (of overlapping ones every second) and compacts the array;
words without a pair leave it. The library merges one pair at a time, so a
round merges more than the leftmost pair only where that gives the same: where
no pair that a merge makes has a rank as good as the round's (else a word gets
one merge in that round; if it is longer than ``LONG``, a heap finishes it, since
runs of one sign would take a round per merge). Characters outside the
vocabulary become the ids of their UTF-8 bytes.

Decoding gathers the bytes of all ids of a batch at once.

Defined results: null or empty text has no ids but the end id and decodes to the
empty text. U+2581 in a text is read as a space, as the library does. Control ids decode to nothing,
bytes that are no UTF-8 to U+FFFD each, null ids to null. Repeated rows each
get a result, an empty table an empty one, and other columns pass through
(``ids`` and ``decoded`` are replaced).
"""

from __future__ import annotations

import codecs
import functools
import heapq
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODEL = "piece_bpe_32k.model"
BLOCK_CHARS = 4 << 20  # texts encoded at once; a longer text is a block of its own
LONG = 64              # symbols, from which a heap finishes words that need a merge at a time
NONE = np.int32(2**31 - 1)
SPACE = "▁"

codecs.register_error("each-byte", lambda e: ("�", e.start + 1))


class Pieces:
    """Vocabulary tables of a model file and the encoder and decoder over them."""

    def __init__(self, name: str):
        import public_tokenizers
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=name if os.path.isabs(name) else public_tokenizers.path(name))
        size = sp.get_piece_size()
        if any(sp.encode(t) != sp.encode(n) for t, n in (("ﬁ Ⅷ", "ﬁ Ⅷ"), ("a  b", f"a{SPACE}{SPACE}b"))) or len(sp.encode("  a")) == len(sp.encode("a")):
            raise ValueError("the model's normaliser is not the identity")
        kinds = [0 if sp.is_control(i) or sp.is_unknown(i) else 1 if sp.is_byte(i) else 2 for i in range(size)]
        pieces = [sp.id_to_piece(i) for i in range(size)]
        self.end = sp.eos_id()
        known = {p: i for i, p in enumerate(pieces) if kinds[i] == 2}
        self.size = size
        self.byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], dtype=np.int32)
        self.char_ids = np.arange(0x110000, dtype=np.int32) + size  # a character outside the vocabulary is size + code point
        for p, i in known.items():
            if len(p) == 1:
                self.char_ids[ord(p)] = i
        long = [p for p in known if len(p) > 1]
        if any(p[k] != SPACE and p[k + 1] == SPACE for p in long for k in range(len(p) - 1)):
            raise ValueError("a piece has a space after another character")
        if any(sp.is_unused(i) for i in range(size)) or any(self.char_ids[ord(c)] >= size for p in long for c in p):
            raise ValueError("a piece has characters that are no pieces")
        used = {c for p in long for c in p}
        #: bytes that are words of their own: ASCII characters in no longer piece
        self.alone = np.array([b < 128 and b != 0x20 and chr(b) not in used for b in range(256)])
        best = {s: r for r, s in enumerate(sorted({sp.get_score(known[p]) for p in long}, reverse=True))}
        keys, ranks, merged = [], [], []
        for p in long:
            for k in range(1, len(p)):
                if p[:k] in known and p[k:] in known:
                    keys.append(known[p[:k]] * size + known[p[k:]])
                    ranks.append(best[sp.get_score(known[p])])
                    merged.append(known[p])
        order = np.argsort(keys)
        self.pairs = np.array(keys, dtype=np.int64)[order]
        self.ranks = np.array([*ranks, NONE], dtype=np.int32)[[*order, len(order)]]
        self.merged = np.array([*merged, -1], dtype=np.int32)[[*order, len(order)]]
        raw = [b"" if k == 0 else bytes([int(p[3:5], 16)]) if k == 1 else p.replace(SPACE, " ").encode() for p, k in zip(pieces, kinds)]
        if sp.unk_id() >= 0:
            raw[sp.unk_id()] = " ⁇ ".encode()
        self.raw = pa.array(raw, pa.binary())
        self.control = np.array([sp.is_control(i) for i in range(size)])
        self.dummy = np.array([k == 2 and p.startswith(SPACE) for p, k in zip(pieces, kinds)])  # starts with what may be the dummy prefix

    def _places(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Places in ``ranks`` and ``merged`` of pairs of symbols; the last place if they have none."""
        key = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.pairs, key)
        at[at == len(self.pairs)] = 0
        return np.where((self.pairs[at] == key) & (left < self.size) & (right < self.size), at, len(self.pairs))

    def _words(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols after all merges of all words, and how many each word has."""
        word = np.arange(len(lengths))
        done_word, done = [], []
        last = np.zeros(len(symbols), dtype=bool)
        last[np.cumsum(lengths) - 1] = True
        place = np.full(len(symbols), len(self.pairs))
        inner = np.flatnonzero(~last)
        place[inner] = self._places(symbols[inner], symbols[inner + 1])
        while len(symbols):
            rank = self.ranks[place]
            starts = np.cumsum(lengths) - lengths
            least = np.minimum.reduceat(rank, starts)
            over = least == NONE
            if over.any():  # words without a pair leave
                out = np.repeat(over, lengths)
                done_word.append(np.repeat(word[over], lengths[over]))
                done.append(symbols[out])
                symbols, place, rank, last = symbols[~out], place[~out], rank[~out], last[~out]
                word, lengths, least = word[~over], lengths[~over], least[~over]
                if not len(symbols):
                    break
                starts = np.cumsum(lengths) - lengths
            number = np.repeat(np.arange(len(word)), lengths)
            at = np.flatnonzero(rank == least[number])
            # of pairs that overlap, every second from the left
            run = np.flatnonzero(np.concatenate(([True], np.diff(at) != 1)))
            at = at[(np.arange(len(at)) - np.repeat(run, np.diff([*run, len(at)]))) % 2 == 0]
            new, mine = self.merged[place[at]], number[at]
            # ranks of the pairs that the merges make, with their neighbours before and after the round
            first, final = at > starts[mine], ~last[at + 1]
            next_ = np.concatenate((np.diff(at) == 2, [False])) & final
            bad = np.zeros(len(at), dtype=bool)
            bad[first] |= self.ranks[self._places(symbols[at[first] - 1], new[first])] <= least[mine[first]]
            bad[final] |= self.ranks[self._places(new[final], symbols[at[final] + 2])] <= least[mine[final]]
            here = np.flatnonzero(next_)
            bad[here] |= self.ranks[self._places(new[here], new[here + 1])] <= least[mine[here]]
            if bad.any():
                single = np.zeros(len(word), dtype=bool)
                single[mine[bad]] = True
                heap = single & (lengths > LONG)
                leftmost = np.concatenate(([True], mine[1:] != mine[:-1]))
                keep = ~heap[mine] & (leftmost | ~single[mine])
                at, new = at[keep], new[keep]
                if heap.any():
                    out = np.repeat(heap, lengths)
                    for w in np.flatnonzero(heap):
                        ids = self._one_by_one(symbols[starts[w]: starts[w] + lengths[w]].tolist())
                        done_word.append(np.full(len(ids), word[w]))
                        done.append(np.array(ids, dtype=np.int32))
                    kept = np.cumsum(~out) - 1
                    at = kept[at]
                    symbols, place, last, number = symbols[~out], place[~out], last[~out], number[~out]
                    number = (np.cumsum(~heap) - 1)[number]
                    word, lengths = word[~heap], lengths[~heap]
                    if not len(at):
                        continue
            symbols[at] = new
            last[at] = last[at + 1]
            gone = np.zeros(len(symbols), dtype=bool)
            gone[at + 1] = True
            lengths = lengths - np.bincount(number[at], minlength=len(lengths))
            moved = at - np.arange(len(at))  # places after compaction
            symbols, place, last = symbols[~gone], place[~gone], last[~gone]
            left = moved[moved > 0] - 1
            changed = np.concatenate((moved, left))
            ends = last[changed]
            place[changed[ends]] = len(self.pairs)
            changed = changed[~ends]
            place[changed] = self._places(symbols[changed], symbols[changed + 1])
        done_word, done = np.concatenate([np.zeros(0, np.int64), *done_word]), np.concatenate([np.zeros(0, np.int32), *done])
        order = np.argsort(done_word, kind="stable")
        return done[order], done_word[order]

    def _one_by_one(self, symbols: list[int]) -> list[int]:
        """All merges of one word, the best and leftmost first."""
        n = len(symbols)
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        heap: list = []

        def offer(lefts: list[int]) -> None:
            lefts = [i for i in lefts if i >= 0 and after[i] < n]
            a, b = [symbols[i] for i in lefts], [symbols[after[i]] for i in lefts]
            for i, x, y, at in zip(lefts, a, b, self._places(np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)).tolist()):
                if at < len(self.pairs):
                    heapq.heappush(heap, (int(self.ranks[at]), i, x, y, int(self.merged[at])))

        offer([*range(n)])
        while heap:
            _, i, x, y, new = heapq.heappop(heap)
            if symbols[i] == x and after[i] < n and symbols[after[i]] == y:
                gone = after[i]
                symbols[i], symbols[gone], after[i] = new, -1, after[gone]
                if after[i] < n:
                    before[after[i]] = i
                offer([before[i], i])
        return [s for s in symbols if s >= 0]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with the end id, one text after another, and how many each has."""
        raws = [f" {t}".replace(SPACE, " ").encode() if t else b"" for t in texts]
        sizes = np.fromiter(map(len, raws), dtype=np.int64, count=len(raws))
        block = b"".join(raws)
        counts = np.ones(len(texts), dtype=np.int64)
        if not block:
            return np.full(len(texts), self.end, dtype=np.int32), counts
        flat = np.frombuffer(block, dtype=np.uint8)
        space, alone = flat == 0x20, self.alone[flat]
        cut = space | alone
        cut[1:] &= ~(space[1:] & space[:-1])
        cut[1:] |= alone[:-1]
        cut[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
        starts = np.flatnonzero(cut)
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(flat))), pa.py_buffer(block)]).dictionary_encode()
        new, which = words.dictionary, words.indices.to_numpy()
        lengths = np.diff(np.frombuffer(new.buffers()[1], dtype=np.int64, count=len(new) + 1))
        unique = new.buffers()[2].to_pybytes()[: int(lengths.sum())]
        points = np.frombuffer(unique.decode().encode("utf-32-le"), dtype=np.uint32)
        chars = np.add.reduceat((np.frombuffer(unique, dtype=np.uint8) & 0xC0) != 0x80, np.cumsum(lengths) - lengths, dtype=np.int64)
        symbols, owner = self._words(self.char_ids[np.where(points == 0x20, ord(SPACE), points)], chars)
        other = np.flatnonzero(symbols >= self.size)
        if len(other):  # ids of the bytes of other characters
            raw = [chr(c).encode() for c in (symbols[other] - self.size).tolist()]
            times = np.ones(len(symbols), dtype=np.int64)
            times[other] = [len(r) for r in raw]
            at = np.cumsum(times) - times
            symbols, owner = np.repeat(symbols, times), np.repeat(owner, times)
            symbols[np.repeat(at[other], times[other]) + np.concatenate([np.arange(len(r)) for r in raw])] = self.byte_ids[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        per_word = np.bincount(owner, minlength=len(new))
        begin = np.cumsum(per_word) - per_word
        many = per_word[which]
        to = np.cumsum(many) - many
        text_of = np.searchsorted(np.cumsum(sizes), starts, side="right")
        ids = np.full(int(many.sum()) + len(texts), self.end, dtype=np.int32)
        ids[np.repeat(to + text_of - to, many) + np.arange(int(many.sum()))] = symbols[np.repeat(begin[which] - to, many) + np.arange(int(many.sum()))]
        return ids, counts + np.bincount(text_of, weights=many, minlength=len(texts)).astype(np.int64)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of the ids, ``counts`` ids each."""
        parts = self.raw.take(pa.array(ids, pa.int32()))
        ends = np.frombuffer(parts.buffers()[1], dtype=np.int32)[parts.offset: parts.offset + len(parts) + 1]
        block = memoryview(parts.buffers()[2] or b"")
        cuts = ends[np.concatenate(([0], np.cumsum(counts)))].tolist()
        real = np.flatnonzero(~self.control[ids])
        first = np.append(real, len(ids))[np.searchsorted(real, np.cumsum(counts) - counts)]  # of each text, behind control ids
        prefix = np.append(self.dummy[ids], False)[first] & (first < np.cumsum(counts))
        return [str(block[lo + p: hi], "utf-8", "each-byte") for lo, hi, p in zip(cuts, cuts[1:], prefix.tolist())]


@functools.lru_cache(maxsize=1)
def pieces(name: str) -> Pieces:
    """The tables, once a worker process."""
    return Pieces(name)


def _slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``most`` bytes of ``column``."""
    for batch in batches:
        buffer = batch.column(column)
        sizes = np.nan_to_num((buffer.value_lengths() if pa.types.is_list(buffer.type) else pa.compute.binary_length(buffer)).to_numpy(zero_copy_only=False).astype(float))
        group = (np.cumsum(sizes) // most).astype(np.int64)
        edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(edges, edges[1:]):
            if hi > lo:
                yield batch.slice(lo, hi - lo)


def encode(texts: DataFrame, name: str = MODEL) -> DataFrame:
    """The rows of ``texts`` with the column ``ids``: ids of ``text`` with the end id."""
    kept = [c for c in texts.columns if c != "ids"]
    texts = texts.select(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches, "text", BLOCK_CHARS):
            ids, counts = pieces(name).encode(part["text"].to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([*part.columns, lists], [*kept, "ids"])

    return texts.mapInArrow(run, T.StructType([*texts.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decode(ids: DataFrame, name: str = MODEL) -> DataFrame:
    """The rows of ``ids`` with the column ``decoded``: the text of the column ``ids``."""
    kept = [c for c in ids.columns if c != "decoded"]
    ids = ids.select(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches, "ids", BLOCK_CHARS):
            lists = part["ids"]
            flat = lists.flatten().fill_null(0)
            counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            out = pa.array(pieces(name).decode(flat.to_numpy(zero_copy_only=False), counts), pa.string())
            out = pa.compute.if_else(lists.is_null(), pa.scalar(None, pa.string()), out)
            yield pa.RecordBatch.from_arrays([*part.columns, out], [*kept, "decoded"])

    return ids.mapInArrow(run, T.StructType([*ids.schema.fields, T.StructField("decoded", T.StringType())]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    both = decode(encode(docs).drop("text"))
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
