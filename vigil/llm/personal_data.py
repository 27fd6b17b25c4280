"""Personal data: patterns, and a skip-chain conditional random field over the tokens around them.

The patterns give the base spans, which always stay. The field labels the tokens
that hold a digit or an @ (no other token can belong to such data) with none,
email, ip, card or phone. Its potentials are token features, a chain between
neighbouring tokens, and skip edges between a token and the next one that is
equal, or equal but for punctuation, however far: loopy message passing carries
a label along them, so one piece of data is labelled alike throughout a
document. Runs of tokens that get a label with probability ``SURE`` or more and
touch no base span are added.

The weights are fitted here, by pseudo-likelihood, to the base labels of a
bounded sample (``SAMPLE`` documents with the smallest hash of doc_id, their
first ``SAMPLE_CHARS`` characters). All documents are scanned whole, in one pass
without a shuffle.

Defined results: null text counts as empty and has no spans. Repeated rows each
get a result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
SURE = 0.95
SAMPLE, SAMPLE_CHARS = 1000, 8192
ROUNDS = 6  # of message passing
# Fixed patterns of the contract. Of the address only the part from the @ on is searched, its left part is
# the run before it; an ip can't begin inside a run of digits. Both are equal to the whole patterns' leftmost
# matches and stay linear on long runs.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TOKEN = re.compile(r"(?<!\S)\S*?[0-9@]\S*")
EDGE = "()[]{}<>\"'.,;:!?*$%&#|"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) by start, then kind."""
    out, end = [], 0
    if "@" in text:
        for m in DOMAIN.finditer(text):
            at = start = m.start()
            while start > end and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                out.append((start, m.end(), 0))
                end = m.end()
    out += [(*m.span(), 1) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((*m.span(), 2))
    if "+" in text:
        out += [(*m.span(), 3) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def features(token: str) -> list[float]:
    digits = "".join(c for c in token if "0" <= c <= "9")
    n = len(digits)
    parts = token.strip(EDGE).split(".")
    quad = len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts)
    return [1.0, "@" in token, bool(DOMAIN.search(token)), quad, quad and all(len(p) <= 3 and int(p) <= 255 for p in parts), token.startswith("+"),
            token.startswith("("), n == len(token.strip(EDGE)), 1 <= n <= 2, n == 3, 4 <= n <= 8, 9 <= n <= 11, 12 <= n <= 19, n > 19,
            12 <= n <= 19 and luhn(digits), "-" in token, any(c.isalpha() for c in token)]


def graph(text: str) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray, np.ndarray]:
    """Tokens' spans, their features, chain edges and skip edges (each as pairs of token numbers)."""
    spans, rows, chain, skip = [], [], [], []
    last: dict[str, int] = {}
    for i, m in enumerate(TOKEN.finditer(text)):
        token = m[0]
        spans.append(m.span())
        rows.append(features(token))
        if i and m.start() - spans[i - 1][1] == 1:
            chain.append((i - 1, i))
        key = re.sub(r"[^0-9a-z@]", "", token.lower()) or token
        if key in last:
            skip.append((last[key], i))
        last[key] = i
    return spans, np.array(rows, dtype=float).reshape(len(rows), len(features(""))), np.array(chain, dtype=int).reshape(-1, 2), np.array(skip, dtype=int).reshape(-1, 2)


def labels_of(spans: list[tuple[int, int]], base: list[tuple[int, int, int]]) -> np.ndarray:
    out = np.zeros(len(spans), dtype=int)
    for start, end, kind in base:
        for i, (s, e) in enumerate(spans):
            if s < end and start < e and not out[i]:
                out[i] = kind + 1
    return out


def fit(texts: list[str], steps: int = 300, rate: float = 0.5, decay: float = 1e-3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Node, chain and skip weights by gradient ascent on the pseudo-likelihood of the base labels."""
    n_labels = len(KINDS) + 1
    xs, ys, before, after, same = [], [], [], [], []
    for text in texts:
        spans, x, chain, skip = graph(text)
        if len(spans):
            y = labels_of(spans, base_spans(text))
            one = np.eye(n_labels)[y]
            b, a, s = (np.zeros((len(y), n_labels)) for _ in range(3))
            b[chain[:, 1]] = one[chain[:, 0]]
            a[chain[:, 0]] = one[chain[:, 1]]
            np.add.at(s, skip[:, 0], one[skip[:, 1]])
            np.add.at(s, skip[:, 1], one[skip[:, 0]])
            for held, part in zip((xs, ys, before, after, same), (x, one, b, a, s)):
                held.append(part)
    node, chain_w, skip_w = np.zeros((len(features("")), n_labels)), np.zeros((n_labels, n_labels)), np.zeros(n_labels)
    if xs:
        x, y, b, a, s = (np.concatenate(p) for p in (xs, ys, before, after, same))
        for _ in range(steps):
            z = x @ node + b @ chain_w + a @ chain_w.T + s * skip_w
            z = np.exp(z - z.max(axis=1, keepdims=True))
            gap = (y - z / z.sum(axis=1, keepdims=True)) / len(y)
            node += rate * (x.T @ gap - decay * node)
            chain_w += rate * (b.T @ gap + (a.T @ gap).T - decay * chain_w)
            skip_w += rate * ((s * gap).sum(axis=0) - decay * skip_w)
    return node, chain_w, np.maximum(skip_w, 0)


def marginals(x: np.ndarray, chain: np.ndarray, skip: np.ndarray, weights) -> np.ndarray:
    """Loopy sum-product: the probability of each label for each token."""
    node, chain_w, skip_w = weights
    pairs = np.concatenate((chain, skip))
    source = np.concatenate((pairs[:, 0], pairs[:, 1]))
    target = np.concatenate((pairs[:, 1], pairs[:, 0]))
    forward = np.concatenate((np.repeat(chain_w[None], len(chain), 0), np.repeat(np.diag(skip_w)[None], len(skip), 0)))
    tables = np.concatenate((forward, forward.transpose(0, 2, 1)))
    half = len(pairs)
    other = np.concatenate((np.arange(half, 2 * half), np.arange(half)))
    own = x @ node
    own -= own.max(axis=1, keepdims=True, initial=-np.inf)
    sent = np.zeros((2 * half, own.shape[1]))
    for _ in range(ROUNDS if half else 0):
        belief = own.copy()
        np.add.at(belief, target, sent)
        out = (belief[source] - sent[other])[:, :, None] + tables
        peak = out.max(axis=1, keepdims=True)
        new = np.log(np.exp(out - peak).sum(axis=1)) + peak[:, 0]
        sent = 0.5 * sent + 0.5 * (new - new.max(axis=1, keepdims=True))
    belief = own.copy()
    np.add.at(belief, target, sent)
    belief = np.exp(belief - belief.max(axis=1, keepdims=True, initial=-np.inf))
    return belief / belief.sum(axis=1, keepdims=True)


def added_spans(text: str, base: list[tuple[int, int, int]], weights) -> list[tuple[int, int, int]]:
    spans, x, chain, skip = graph(text)
    if not spans:
        return []
    chance = marginals(x, chain, skip, weights)
    best = np.where(chance.max(axis=1) >= SURE, chance.argmax(axis=1), 0)
    best[labels_of(spans, base) > 0] = 0
    joined = set(chain[:, 1].tolist())
    out: list[tuple[int, int, int]] = []
    for i in np.flatnonzero(best).tolist():
        token = text[spans[i][0]: spans[i][1]]
        start = spans[i][0] + len(token) - len(token.lstrip(EDGE))
        end = spans[i][0] + len(token.rstrip(EDGE))
        if start >= end:
            continue
        if i in joined and best[i - 1] == best[i] and out and out[-1][1] <= start:
            out[-1] = (out[-1][0], end, out[-1][2])
        else:
            out.append((start, end, int(best[i]) - 1))
    return out


def _named(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans and n_added of every document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # ids first, so that a task sends SAMPLE numbers to the driver and not as many texts
    ids = (docs.where(F.regexp_like("text", F.lit("[0-9@]")) & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("s")).distinct()
           .orderBy(F.xxhash64("s"), "s").limit(SAMPLE))
    sample = (docs.join(F.broadcast(ids), F.col("doc_id") == F.col("s"), "left_semi")  # SAMPLE rows at most
              .select("doc_id", F.substring("text", 1, SAMPLE_CHARS).alias("text")).orderBy("doc_id", "text").limit(SAMPLE).collect())
    weights = fit([r.text for r in sample])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                base = [base_spans(t) for t in part["text"].to_pylist()]
                more = [added_spans(t, b, weights) for t, b in zip(part["text"].to_pylist(), base)]
                counts = [pa.array([sum(s[2] == k for s in b) for b in base], pa.int64()) for k in range(len(KINDS))]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], *counts, pa.array([hashlib.sha256(_named(b).encode()).hexdigest() for b in base], pa.string()),
                     pa.array([_named(sorted(b + m)) for b, m in zip(base, more)], pa.string()), pa.array(list(map(len, more)), pa.int64())],
                    ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    return docs.mapInArrow(scan, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
