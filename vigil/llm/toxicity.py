"""Toxicity by compression distance.

Two zstandard dictionaries are made from labelled text, one from ordinary, one
from toxic documents. A document is cut into windows; each window is compressed
with both, and what the toxic dictionary saves over the ordinary one tells how
much of the window it knows from toxic text. Shares of windows above calibrated
savings give the score, by a logistic model.

Both dictionaries share the ordinary content (so that common words cost the same
in both); the toxic one ends in the toxic samples: the pieces of toxic training
text whose six-byte runs stand in clearly more toxic than ordinary documents.
Without that choice the trainer fills it with the common words of toxic text.

Training uses a bounded sample of whole texts: at most ``SAMPLE`` documents of each
label by hash of doc_id, only from rows whose crc32(doc_id) mod 5 is not 0. Two
thirds make the dictionaries, from up to ``SPANS`` spans drawn evenly from all over
each text. The rest calibrates: their features are made of the whole texts, like
those of scored documents, and in tasks, so the driver gets spans and features
only. Only text enters a score. All documents are scored whole in one pass without
a shuffle.

Defined results: null, empty and wordless texts score as one empty window. With
no rows of one label every score is 0. Repeated rows each get a result. Rows
with a null doc_id are never held out. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.text import written

SAMPLE = 2000
SPANS, SPAN = 32, 512           # of a text, for the dictionaries; a shorter text is one span
WINDOW, OVERLAP = 48, 8         # bytes
GRAM = 6
MIN_Z, MIN_RATIO = 6.0, 6.0     # how clearly, and how many times, more toxic than ordinary documents hold a run
BASE_BYTES, TOXIC_BYTES = 16384, 4096
LEVEL = 3
FALSE_ALARMS = 0.04             # share of ordinary calibration documents that may score 0.5 or more


def plain(text: str | None) -> bytes:
    return b" ".join([b"", *(text or "").lower().encode().split(), b""])


def windows(raw: bytes) -> list[bytes]:
    return [raw[i: i + WINDOW + OVERLAP] for i in range(0, max(len(raw), 1), WINDOW)]


def spans(raw: bytes) -> list[bytes]:
    """``SPANS`` stretches that lie evenly from a text's beginning to its end; the whole text if it is not longer."""
    if len(raw) <= SPANS * SPAN:
        return [raw]
    return [raw[at: at + SPAN] for at in (i * (len(raw) - SPAN) // (SPANS - 1) for i in range(SPANS))]


def _grams(raw: bytes) -> np.ndarray:
    a = np.frombuffer(raw, dtype=np.uint8)
    n = max(len(a) - GRAM + 1, 0)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(GRAM):
        out = out << np.uint64(8) | a[j: j + n]
    return out


def toxic_pieces(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> bytes:
    """The toxic dictionary's own content, from the spans of each text, the most frequent piece last (the cheapest to refer to)."""
    of_text = lambda parts: np.unique(np.concatenate([_grams(x) for x in parts]))
    keys, n_toxic = np.unique(np.concatenate([of_text(t) for t in toxic]), return_counts=True)
    others, n = np.unique(np.concatenate([of_text(t) for t in ordinary]), return_counts=True)
    at = np.minimum(np.searchsorted(others, keys), max(len(others) - 1, 0))
    n_ordinary = np.where(others[at] == keys, n[at], 0) if len(others) else np.zeros(len(keys), dtype=int)
    p, q = n_toxic / len(toxic), n_ordinary / len(ordinary)
    spread = np.sqrt((n_toxic + n_ordinary + 1) / (len(toxic) + len(ordinary)) * (1 / len(toxic) + 1 / len(ordinary)))
    ratio = (n_toxic + 0.5) / len(toxic) / ((n_ordinary + 0.5) / len(ordinary))
    chosen = keys[((p - q) / spread > MIN_Z) & (ratio > MIN_RATIO)]
    pieces: Counter = Counter()
    for raw in (x for t in toxic for x in t):
        hit = np.flatnonzero(np.isin(_grams(raw), chosen))
        if len(hit):
            edge = np.flatnonzero(np.diff(hit) > GRAM)
            for a, b in zip(np.concatenate(([0], edge + 1)), np.concatenate((edge, [len(hit) - 1]))):
                pieces[raw[hit[a]: hit[b] + GRAM]] += 1
    kept, size = [], 0
    for piece, _ in sorted(pieces.items(), key=lambda x: (-x[1], x[0])):
        if size + len(piece) <= TOXIC_BYTES:
            kept.append(piece)
            size += len(piece)
    return b"".join(reversed(kept))


def ordinary_content(ordinary: list[list[bytes]]) -> bytes:
    samples = [w for t in ordinary for raw in t for w in windows(raw)]
    try:
        return zstandard.train_dictionary(BASE_BYTES, samples, k=64, d=8).as_bytes()
    except zstandard.ZstdError:  # too few samples
        return b"".join(samples)[:BASE_BYTES]


class Model:
    """The two dictionaries and the calibrated weights; zstandard objects are made where it is used."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        # the ordinary dictionary is filled up to equal length, so that distances cost the same
        self.contents = (ordinary + ordinary[: len(toxic)], ordinary + toxic)
        self.weights: np.ndarray | None = None
        self.compressors = None

    def __getstate__(self):
        return self.__dict__ | {"compressors": None}

    def _ready(self):
        if self.compressors is None:
            made = []
            for content in self.contents:
                shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                shared.precompute_compress(level=LEVEL)
                made.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_content_size=False, write_dict_id=False))
            self.compressors = made
        return self.compressors

    def savings(self, text: str | None) -> np.ndarray:
        """Per window: bytes that the toxic dictionary saves over the ordinary one."""
        ordinary, toxic = self._ready()
        parts = windows(plain(text))
        return np.array([len(ordinary.compress(w)) - len(toxic.compress(w)) for w in parts], dtype=float)

    def features(self, text: str | None) -> np.ndarray:
        s = np.sort(self.savings(text))[::-1]
        share = np.array([np.mean(s >= k) for k in (2, 4, 6)])
        return np.concatenate((share, np.sqrt(share), [s[0], s[:3].mean(), s.mean()]))

    def calibrate(self, toxic: list, ordinary: list, steps: int = 800, rate: float = 0.3, decay: float = 1e-3) -> None:
        """Weights from the features of whole texts of each label."""
        x = np.array([*toxic, *ordinary])
        y = np.repeat([1.0, 0.0], [len(toxic), len(ordinary)])
        of = np.where(y == 1, 0.5 / len(toxic), 0.5 / len(ordinary))
        mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        x = (x - mean) / scale
        w, b = np.zeros(x.shape[1]), 0.0
        for _ in range(steps):
            gap = (y - 1 / (1 + np.exp(-(x @ w + b)))) * of
            w += rate * 4 * (x.T @ gap - decay * w)
            b += rate * 4 * gap.sum()
        # the threshold: 0.5 lies half way from the last ordinary text that must stay below it to the next higher level,
        # since equal texts of a small sample would else be on either side by rounding
        level = x @ w
        below = np.sort(level[y == 0])[len(ordinary) - int(FALSE_ALARMS * len(ordinary)) - 1]
        b = -(below + level[level > below + 1e-9].min(initial=below + 1.0)) / 2
        self.weights = np.concatenate((w / scale, [b - (w / scale) @ mean]))

    def score(self, text: str | None) -> float:
        if self.weights is None:
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(self.features(text) @ self.weights[:-1] + self.weights[-1], -30, 30))))


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame | None:
    """toxic, place, calibrates and text of the sampled texts; None if a label has too few."""
    chosen = []
    for label in (1, 0):
        ids = (labels.where((F.col("toxic") == label) & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("l_doc")).distinct()
               .where(~held_out(F.col("l_doc"))).orderBy(F.xxhash64("l_doc"), "l_doc").limit(SAMPLE))
        rows = (docs.join(F.broadcast(ids), F.col("doc_id") == F.col("l_doc"))  # at most SAMPLE ids
                .where("text is not null").select(F.xxhash64("doc_id").alias("h"), "doc_id", F.md5("text").alias("print"))
                .orderBy("h", "doc_id", "print").limit(2 * SAMPLE).collect())
        first = {}
        for r in rows:
            first.setdefault(r.print, r.doc_id)
        cut = 2 * len(first) // 3
        if cut == 0:
            return None
        chosen += [(label, place, place >= cut, doc, mark) for place, (mark, doc) in enumerate(first.items())]
    chosen = docs.sparkSession.createDataFrame(chosen, "toxic int, place int, calibrates boolean, c_doc long, c_print string")
    rows = docs.join(F.broadcast(chosen), (F.col("doc_id") == F.col("c_doc")) & (F.md5("text") == F.col("c_print")))
    return written(rows.select("toxic", "place", "calibrates", "text").dropDuplicates(["toxic", "place"]), "toxic-sample")


def trained(docs: DataFrame, labels: DataFrame) -> Model:
    sample = _sample(docs, labels)
    if sample is None:
        return Model(b"", b"")

    def made(rows: DataFrame, f, kind: str) -> list[list]:
        """``f`` of the texts of each label, in the order of their places."""
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values = pa.array([f(t) for t in batch["text"].to_pylist()], pa.list_(pa.binary() if kind == "binary" else pa.float64()))
                yield pa.RecordBatch.from_arrays([batch["toxic"], batch["place"], values], ["toxic", "place", "value"])
        got = sorted(rows.mapInArrow(scan, f"toxic int, place int, value array<{kind}>").collect(), key=lambda r: r.place)
        return [[r.value for r in got if r.toxic == label] for label in (1, 0)]

    raw = [[[bytes(x) for x in t] for t in texts] for texts in made(sample.where("not calibrates"), lambda t: spans(plain(t)), "binary")]
    model = Model(ordinary_content(raw[1]), toxic_pieces(*raw))
    model.calibrate(*made(sample.where("calibrates"), lambda t: model.features(t).tolist(), "double"))
    return model


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = trained(docs, labels)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                ids = part["doc_id"].to_pylist()
                scores = [model.score(t) for t in part["text"].to_pylist()]
                held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 0 for i in ids]
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(held, pa.bool_()), pa.array(scores, pa.float64()),
                                                  pa.array([int(s >= 0.5) for s in scores], pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    return docs.mapInArrow(scan, "doc_id long, held_out boolean, score double, predicted int")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))
