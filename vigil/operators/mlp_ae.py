"""Non-linear reconstruction model (L4b-L6): an undercomplete MLP autoencoder
fitted as a data-parallel Spark job.

Each epoch is ONE job over the fit table: every partition starts from the
current weights (shipped in the task closure, size bounded by the model),
runs local mini-batch SGD over its own rows (parallelized SGD with model
averaging, Zinkevich et al. 2010) and emits ``(n_rows, weights)``. Rows are taken
as they come, in blocks of ``BLOCK`` that are shuffled one by one, so a task holds
one block whatever its partition's size, and every row is used once an epoch. The
row-weighted average is reduced with a positional ``groupBy`` (bounded by the
parameter count, never by the data). Validation loss of the incoming weights
is computed in the same pass. The driver keeps early stopping with patience,
best-weight restore and rate halving (L5). Scoring is an Arrow ``mapInPandas``
forward pass (L7, L8).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: default network shape and fit control of the reference model
HIDDEN = (128, 64, 32)
LATENT = 16
DIRECT_REDUCE_VALUES = 4_000_000
BLOCK = 1 << 15         # rows that a task holds and shuffles at once
SCORED = 1 << 12        # rows of a forward pass without gradients


def layer_sizes(d: int, hidden: Sequence[int], latent: int) -> list[int]:
    return [d, *hidden, latent, *reversed(hidden), d]


def init_weights(sizes: list[int], seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    parts = []
    for a, b in zip(sizes[:-1], sizes[1:]):
        parts.append(rng.normal(0, np.sqrt(2.0 / a), (a, b)).ravel())   # He initialisation
        parts.append(np.zeros(b))
    return np.concatenate(parts)


def unpack(w: np.ndarray, sizes: list[int]):
    layers, i = [], 0
    for a, b in zip(sizes[:-1], sizes[1:]):
        W = w[i:i + a * b].reshape(a, b)
        i += a * b
        layers.append((W, w[i:i + b]))
        i += b
    return layers


def forward(x: np.ndarray, layers):
    acts = [x]
    for j, (W, b) in enumerate(layers):
        z = acts[-1] @ W + b
        acts.append(z if j == len(layers) - 1 else np.maximum(z, 0.0))
    return acts


def reconstruction_error(x: np.ndarray, layers) -> np.ndarray:
    out = np.empty(len(x))
    for s in range(0, len(x), SCORED):
        part = x[s:s + SCORED]
        out[s:s + SCORED] = ((part - forward(part, layers)[-1]) ** 2).mean(axis=1)
    return out


def blocks(batches, columns: Sequence[str], size: int):
    """The columns of all rows as matrices of ``size`` rows, the last one of what is left."""
    block, n = None, 0
    for pdf in batches:
        x = pdf[list(columns)].to_numpy(dtype="float64")
        while len(x):
            if block is None:
                block, n = np.empty((size, x.shape[1])), 0  # pages are touched as rows come
            take = min(size - n, len(x))
            block[n:n + take] = x[:take]
            x, n = x[take:], n + take
            if n == size:
                yield block
                block = None
    if block is not None:
        yield block[:n]


def sgd_pass(x: np.ndarray, layers, lr: float, batch: int, rng) -> None:
    """In-place mini-batch SGD on the MSE of reconstruction (plain backprop)."""
    order = rng.permutation(len(x))
    for s in range(0, len(x), batch):
        xb = x[order[s:s + batch]]
        acts = forward(xb, layers)
        grad = 2.0 * (acts[-1] - xb) / xb.size
        for j in range(len(layers) - 1, -1, -1):
            W, b = layers[j]
            gW, gb = acts[j].T @ grad, grad.sum(axis=0)
            if j > 0:
                grad = (grad @ W.T) * (acts[j] > 0)
            np.clip(gW, -5, 5, out=gW)
            W -= lr * gW
            b -= lr * gb


@dataclass
class MLPAutoencoder:
    features: list[str]
    sizes: list[int]
    weights: np.ndarray
    history: list = field(default_factory=list)
    threshold: float | None = None

    def score(self, df: DataFrame, keep: Sequence[str] = ("row_id",), name: str = "anomaly_score") -> DataFrame:
        feats, sizes, w = list(self.features), self.sizes, self.weights
        keep = [k for k in keep if k in df.columns]
        src = df.select(*keep, *[F.col(f).cast("double").alias(f) for f in feats])
        schema = T.StructType([src.schema[k] for k in keep] + [T.StructField(name, T.DoubleType())])

        def run(batches):
            layers = unpack(w, sizes)
            for pdf in batches:
                out = pdf[keep].copy()
                out[name] = reconstruction_error(pdf[feats].to_numpy(dtype="float64"), layers)
                yield out

        return src.mapInPandas(run, schema)

    def n_params(self) -> int:
        return int(self.weights.size)


def fit_mlp(df: DataFrame, features: Sequence[str], val_col: str | None = None, hidden=HIDDEN,
            latent: int = LATENT, epochs: int = 10, lr: float = 1e-3, batch: int = 128, patience: int = 4,
            min_lr: float = 1e-7, seed: int = 42, val_label: str | None = None) -> MLPAutoencoder:
    """Fit on rows with ``val_col`` = 0 (all rows if None); validate on ``val_col`` = 1.

    ``val_label`` (L6): after every epoch the validation rows are scored and their exact
    ROC AUC recorded; the weights with the best validation AUC are kept (null AUC - one
    class only - never counts as best)."""
    feats = list(features)
    sizes = layer_sizes(len(feats), hidden, latent)
    w = init_weights(sizes, seed)
    cols = [F.col(f).cast("double").alias(f) for f in feats]
    vflag = (F.col(val_col).cast("int") if val_col else F.lit(0)).alias("_val")
    src = df.select(vflag, *cols)
    out_schema = "n double, val_n double, val_loss double, w array<double>"
    best = (np.inf, w.copy())
    best_auc = None
    wait = 0
    history = []
    for epoch in range(epochs):
        cur, step = w, lr

        def local(batches, cur=cur, step=step, epoch=epoch):
            layers = unpack(cur.copy(), sizes)
            val_layers = unpack(cur, sizes)
            n = val_n = 0
            vloss = 0.0
            for x in blocks(batches, ["_val", *feats], BLOCK):
                is_val = x[:, 0] == 1
                xv = x[is_val, 1:]
                val_n += len(xv)
                vloss += float(reconstruction_error(xv, val_layers).sum())
                xt = x[~is_val, 1:]
                n += len(xt)
                sgd_pass(xt, layers, step, batch, np.random.default_rng(seed * 1000 + epoch + n))
            flat = np.concatenate([p.ravel() for W, b in layers for p in (W, b)])
            yield pd.DataFrame({"n": [float(n)], "val_n": [float(val_n)], "val_loss": [vloss],
                                "w": [flat.tolist()]})

        parts = src.mapInPandas(local, out_schema)
        if src.rdd.getNumPartitions() * w.size <= DIRECT_REDUCE_VALUES:
            # few partitions: their vectors fit the driver comfortably
            rows = parts.collect()
            total = sum(r["n"] for r in rows)
            if total:
                w = sum(np.asarray(r["w"]) * r["n"] for r in rows) / total
            stats = {"vn": sum(r["val_n"] for r in rows), "vl": sum(r["val_loss"] for r in rows)}
        else:
            # Row-weighted average of the partition models, reduced by position (bounded by the model).
            parts = parts.persist()
            avg = (parts.select("n", F.posexplode("w").alias("i", "v"))
                   .groupBy("i").agg(F.sum(F.col("v") * F.col("n")).alias("s"), F.sum("n").alias("n"))
                   .orderBy("i").collect())                     # one row per parameter
            stats = parts.agg(F.sum("val_n").alias("vn"), F.sum("val_loss").alias("vl")).first()
            parts.unpersist()
            total = avg[0]["n"] if avg else 0.0
            if total:
                w = np.array([r["s"] / total for r in avg])
        vloss = stats["vl"] / stats["vn"] if stats["vn"] else None
        history.append({"epoch": epoch, "val_loss_of_incoming": vloss, "lr": step})
        if val_label and val_col:
            from vigil.operators.evaluate import roc_auc
            probe = MLPAutoencoder(feats, sizes, w)
            vrows = df.where(F.col(val_col) == 1)
            auc = roc_auc(probe.score(vrows, keep=(val_label,)), "anomaly_score", val_label).first()["roc_auc"]
            history[-1]["val_auc"] = auc
            if auc is not None and (best_auc is None or auc > best_auc[0]):
                best_auc = (auc, w.copy())
        if vloss is not None:
            if vloss < best[0]:
                best, wait = (vloss, cur.copy()), 0
            else:
                wait += 1
                if wait == max(1, patience // 2):
                    lr = max(lr / 2.0, min_lr)
                if wait >= patience:
                    w = best[1]
                    break
    if best_auc is not None:
        return MLPAutoencoder(feats, sizes, best_auc[1], history)
    if val_col and np.isfinite(best[0]):
        w = best[1] if history and history[-1]["val_loss_of_incoming"] is not None \
            and history[-1]["val_loss_of_incoming"] > best[0] else w
    return MLPAutoencoder(feats, sizes, w, history)
