"""The fit of the MLP holds one block of a partition's rows, and still uses every row."""

import numpy as np
import pandas as pd

from vigil.operators import mlp_ae


def test_blocks_take_rows_as_they_come():
    taken = []

    def batches():
        for k in range(10):
            taken.append(k)
            yield pd.DataFrame({"a": np.arange(7.0) + 7 * k, "b": 1.0, "other": "x"})

    found = mlp_ae.blocks(batches(), ["a", "b"], 16)
    first = next(found)
    assert len(first) == 16 and taken == [0, 1, 2]  # not the whole partition
    got = [first, *found]
    assert [len(x) for x in got] == [16, 16, 16, 16, 6]
    np.testing.assert_array_equal(np.concatenate(got)[:, 0], np.arange(70.0))
    assert list(mlp_ae.blocks(iter([]), ["a"], 4)) == []


def test_a_partition_of_several_blocks_is_used_whole(spark):
    n = mlp_ae.BLOCK * 5 // 2
    rows = spark.range(n, numPartitions=1).selectExpr("cast(id % 4 = 0 as int) as is_val", "cast(id as double) / 1e5 as a", "sin(id) as b", "cos(id) as c")
    model = mlp_ae.fit_mlp(rows, ["a", "b", "c"], val_col="is_val", hidden=(4,), latent=2, epochs=3, lr=1e-2)
    x = rows.where("is_val = 1").toPandas()[["a", "b", "c"]].to_numpy()
    start = mlp_ae.unpack(mlp_ae.init_weights(model.sizes, 42), model.sizes)
    losses = [h["val_loss_of_incoming"] for h in model.history]
    want = ((x - mlp_ae.forward(x, start)[-1]) ** 2).mean(axis=1).mean()
    assert abs(losses[0] - want) < 1e-9 and losses[-1] < losses[0]
