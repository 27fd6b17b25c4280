"""Time-ordered splits, exact-count sampling and label shuffles.

A split never sorts or numbers the rows: the keys at the cut positions are found
by exact selection on the key columns, and the split is a projection that compares
each row's key with the cut keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators.draws import draw_key, permuted
from vigil.operators.rank import before_key, global_rank
from vigil.operators.select import rows_at

TIME_ORDER = ("transaction_date", "row_id")
#: names of helper columns
DRAW, POSITION, SOURCE, MOVED = "__draw", "__position", "__source", "__moved"


def cut_sizes(n: int, ratios: Sequence[float]) -> list[int]:
    """Cumulative cut positions: ``int(r * n)`` per ratio, as slicing in the reference."""
    cuts, acc = [], 0
    for r in ratios:
        acc += int(r * n)
        cuts.append(acc)
    return cuts


def split_column(df: DataFrame, ratios: Sequence[float], labels: Sequence[str],
                 order: Sequence[str] = TIME_ORDER, name: str = "split") -> DataFrame:
    """Label each row by its position in ``order`` (unique): first ``int(r0*n)`` rows get
    ``labels[0]``, the next ``int(r1*n)`` ``labels[1]``, ..., the rest ``labels[-1]``."""
    order = list(order)
    n, keys = rows_at(df, order, lambda n: cut_sizes(n, ratios))
    cuts = cut_sizes(n, ratios)
    expr = None
    for cut, label in zip(cuts, labels):
        cond = before_key(order, keys.get(cut)) if cut < n else F.lit(True)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    expr = expr.otherwise(F.lit(labels[-1])) if expr is not None else F.lit(labels[-1])
    return df.withColumn(name, expr)


def split_ranked(df: DataFrame, ratios: Sequence[float], labels: Sequence[str],
                 time: str = "transaction_date", rank: str = "row_id", name: str = "split") -> DataFrame:
    """``split_column`` in the order (``time``, ``rank``) of rows whose ``rank`` numbers them from 0 in an order of
    ``time``, nulls first: the cut keys follow from two counts. As there, rows without a time precede no cut."""
    n, untimed = df.agg(F.count(F.lit(1)), F.count_if(F.col(time).isNull())).first()
    expr = None
    for cut, label in zip(cut_sizes(n, ratios), labels):
        at = untimed + cut
        cond = F.col(time).isNotNull() & (F.col(rank) < at) if at < n else F.lit(True)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return df.withColumn(name, expr.otherwise(F.lit(labels[-1])) if expr is not None else F.lit(labels[-1]))


def split_3way(df: DataFrame, train: float = 0.8, val: float = 0.1, order=TIME_ORDER) -> DataFrame:
    """Train / val / test by time."""
    return split_column(df, [train, val], ["train", "val", "test"], order)


def split_2way(df: DataFrame, train: float = 0.8, order=TIME_ORDER) -> DataFrame:
    """Train / test by time (0.8 or 0.9)."""
    return split_column(df, [train], ["train", "test"], order)


def tail_rows(df: DataFrame, frac: float = 0.2, order=TIME_ORDER, name: str = "is_tail") -> DataFrame:
    """C4: flag the last ``int(frac * n)`` rows in order with 1."""
    order = list(order)
    _, keys = rows_at(df, order, lambda n: [n - int(frac * n)])
    if not keys:  # no tail
        return df.withColumn(name, F.lit(0))
    return df.withColumn(name, (~before_key(order, next(iter(keys.values())))).cast("int"))


def hash_key(key: str, seed: int) -> F.Column:
    return draw_key(F.col(key), seed)


def random_split(df: DataFrame, seed: int = 42, key: str = "row_id", parts: int = 10, name: str = "split") -> DataFrame:
    """About one row in ``parts`` is ``test``, the others ``train``, by the seeded number of the row's key: a row keeps its side
    whatever the partitions, and rows of one key are never parted."""
    return df.withColumn(name, F.when(hash_key(key, seed) % parts == 0, "test").otherwise("train"))


def sample_exact(df: DataFrame, frac: float, seed: int = 42, key: str = "row_id") -> DataFrame:
    """Exactly ``int(n * frac)`` rows, the first in the order of seeded numbers of ``key`` (no driver collect)."""
    h = df.withColumn(DRAW, hash_key(key, seed))
    _, keys = rows_at(h, [DRAW, key], lambda n: [int(n * frac)])
    return h.where(before_key([DRAW, key], next(iter(keys.values()), None))).drop(DRAW)


def shuffle_labels(df: DataFrame, label: str, seed: int = 42, key: str = "row_id",
                   num_partitions: int | None = None) -> DataFrame:
    """Permute ``label`` across rows: the row at position i in the order of ``key`` (unique) receives the label of the row
    at the position that a seeded permutation gives. One global rank and one equi-join on positions, each of which occurs once."""
    ranked = global_rank(df, [key], POSITION, num_partitions)
    n = ranked.count()
    moved = ranked.select(F.col(POSITION).alias(SOURCE), F.col(label).alias(MOVED))
    taken = ranked.withColumn(SOURCE, permuted(F.col(POSITION), n, seed)).join(moved, SOURCE)
    return taken.withColumn(label, F.col(MOVED)).select(df.columns)
