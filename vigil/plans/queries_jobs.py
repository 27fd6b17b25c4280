"""Driver queries for jobs and sources: exact sample, random split, the batch
prediction job (L12), run-record scan and best-run selection (A9, M12), ranked
records with the nested feature map (N1), model size (L13)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from vigil.operators import evaluate as E
from vigil.operators.alerts import DISPLAY, classify_and_rank
from vigil.operators.model import AnomalyModel
from vigil.operators.fingerprint import compare, fingerprints
from vigil.operators.split import random_split, sample_exact
from vigil.plans import prepare as P
from vigil.plans.common import rounded
from vigil.functions.clean import card_clean_params
from vigil.session import checkpoint, ensure_checkpoint_dir
from vigil.sources import io
from vigil.sources.fixtures import card
from vigil.sources.tables import read_table


FINGERPRINT_KEYS = {"events": ["event_id"], "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]}


def _scratch(spark, name):
    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def q_sample_exact(spark, sf):
    """Exactly int(0.1 n) rows by a seeded order."""
    return rounded(sample_exact(P.clean_card(spark, sf).select("row_id", "amount", "is_fraudulent"), 0.1, seed=42))


def q_random_split(spark, sf):
    """90/10 split by seeded numbers of the row ids (stable across runs, partitionings and engines)."""
    return random_split(P.clean_card(spark, sf).select("row_id", "is_fraudulent"), seed=42)


def saved_model(spark, sf, **options):
    """The card split, a model fitted on its train rows, and the same model saved and loaded again."""
    split = P.card_split(spark, sf)
    model = AnomalyModel.fit(split.where(F.col("split") == "train").drop("split"), clean_params=card_clean_params(card(spark, sf)), **options)
    path = _scratch(spark, "model")
    model.save(spark, path)
    return split, model, AnomalyModel.load(spark, path)


def q_batch_predict(spark, sf):
    """Fit and save the model, load it, score the test rows by reconstruction error, write predictions, read them back."""
    split, _, loaded = saved_model(spark, sf)
    out = _scratch(spark, "predictions")
    io.write_predictions(loaded.predict(split.where(F.col("split") == "test").drop("split")), out)
    return rounded(spark.read.parquet(out).select("row_id", "anomaly_score", "predicted_fraud", "is_fraudulent"))


def q_predict_reloaded(spark, sf):
    """For every test row, whether all features, the score and the label agree before saving and after loading."""
    split, model, loaded = saved_model(spark, sf)
    test = split.where(F.col("split") == "test").drop("split")
    both = []
    for name, m in (("a", model), ("b", loaded)):
        table = checkpoint(m.features.transform(test, keep=("row_id", "is_fraudulent")))
        row = F.struct(*[F.col(f).cast("double") for f in m.scaler.features])
        scored = E.predict(m._scored(table, ("row_id",)), "anomaly_score", m.linear.threshold)
        both.append(table.select("row_id", "is_fraudulent", row.alias("features")).join(scored, "row_id").alias(name))
    j = both[0].join(both[1], "row_id", "full")
    same = {f"same_{k}": F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for k, c in
            (("features", "features"), ("score", "anomaly_score"), ("label", "predicted_fraud"), ("target", "is_fraudulent"))}
    return j.select("row_id", F.lit(len(model.scaler.features)).alias("n_features"), *[v.alias(k) for k, v in same.items()],
                    (F.col("b.anomaly_score") >= 0).alias("non_negative"))


def q_clean_card_csv(spark, sf):
    """A1: the raw card table written as CSV, read with the declared schema and cleaned."""
    from vigil.functions.clean import clean
    from vigil.plans.common import epoch_us
    from vigil.sources.csv import read_csv
    path = _scratch(spark, "card-csv")
    card(spark, sf).write.option("header", True).csv(path)
    df = clean(read_csv(spark, path).rows)
    return rounded(df.select("row_id", "time", "amount", epoch_us("transaction_date").alias("transaction_us"), "transaction_hour", "is_fraudulent"))


def q_event_time(spark, sf):
    """Event time of the raw card rows, their seconds after the base date without rescaling."""
    from vigil.functions.clean import event_time
    from vigil.plans.common import epoch_us
    return event_time(card(spark, sf).select("row_id", "time")).select("row_id", epoch_us("transaction_date").alias("transaction_us"))


def q_run_records(spark, sf):
    """A9 + M12: per-run metrics written as JSON run records, scanned back with a declared schema,
    best run chosen by AUC."""
    from vigil.plans.queries_eval import RUN_SCORES
    ft = P.card_features(spark, sf)[1].where(F.col("split") == "test")
    runs = ft.select("is_fraudulent", F.explode(F.array(*[
        F.struct(F.lit(c).alias("combination_name"), F.col(c).cast("double").alias("score")) for c in RUN_SCORES
    ])).alias("r")).select("is_fraudulent", "r.*")
    auc = E.roc_auc(runs, "score", "is_fraudulent", by=["combination_name"])
    rate = ft.agg(F.avg("is_fraudulent")).first()[0]
    recs = auc.select("roc_auc", "combination_name", F.lit(rate).alias("fraud_rate"),
                      F.lit(len(RUN_SCORES)).cast("long").alias("feature_count"))
    path = _scratch(spark, "runs")
    recs.write.mode("overwrite").json(path)
    scanned = io.read_run_records(spark, f"{path}/*.json")
    best = scanned.agg(F.max_by("combination_name", F.struct("roc_auc", "combination_name"))).first()[0]
    return rounded(scanned.select("combination_name", "roc_auc", "fraud_rate", "feature_count",
                                  (F.col("combination_name") == F.lit(best)).alias("is_best")))


def q_ranked_records(spark, sf):
    """Every test row classified at p99 and ranked, with its display features as a map."""
    ft = P.card_features(spark, sf)[1].where(F.col("split") == "test")
    scored = ft.select("row_id", "is_fraudulent", F.col("amount_z_score").alias("anomaly_score"),
                       F.create_map(*[x for c in DISPLAY for x in (F.lit(c), F.col(c).cast("double"))])
                       .alias("engineered_features"))
    thr = E.threshold_at(scored, "anomaly_score", 99)
    return classify_and_rank(scored, thr)


def q_alert_records(spark, sf):
    """B16 + N1 + N4: the ranked records of the test rows as plain columns: score, prediction at p99, the label looked up in the
    label table by row id, and all 41 display features."""
    ft = P.card_features(spark, sf)[1].where(F.col("split") == "test")
    shown = [F.col(c).cast("double").alias(c) for c in DISPLAY if c in ft.columns]
    scored = ft.select("row_id", F.col("amount_z_score").alias("anomaly_score"), *shown)
    labels = card(spark, sf).select("row_id", "is_fraudulent")
    ranked = classify_and_rank(scored, E.threshold_at(scored, "anomaly_score", 99), labels=labels)
    return rounded(ranked.drop("is_fraudulent"))


def q_table_fingerprints(spark, sf):
    """The order-free fingerprint of every column of three tables, whole."""
    out = None
    for name, key in FINGERPRINT_KEYS.items():
        part = fingerprints(read_table(spark, sf, name), key).select(F.lit(name).alias("table"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def q_check_reloaded_table(spark, sf):
    """Every column of the feature table against the same table written and read again, by fingerprints."""
    table = checkpoint(P.card_features(spark, sf)[1])  # a digest reads a value several times: not its whole expression each time
    path = _scratch(spark, "features")
    table.write.parquet(path)
    return compare(table, spark.read.parquet(path), ["row_id"])


def q_check_stored_params(spark, sf):
    """All stored parameters of the fitted model against those that a loaded copy stores again, by fingerprints."""
    _, model, loaded = saved_model(spark, sf)
    paths = [_scratch(spark, "model-a"), _scratch(spark, "model-b")]
    for m, path in zip((model, loaded), paths):
        m.save(spark, path)
    out = None
    for name, key in (("features/params", ()), ("parts", ("position",)), ("model", ())):
        part = compare(*[spark.read.parquet(f"{p}/{name}") for p in paths], key).select(F.lit(name).alias("table"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def q_model_size(spark, sf):
    """Parameter count of the fitted linear reconstruction model."""
    from vigil.plans.queries_eval import linear_model
    model, _ = linear_model(spark, sf)
    d, k = model.linear.components.shape
    return spark.createDataFrame([(int(d), int(k), int(model.linear.n_params()))],
                                 "n_features int, latent_dim int, n_params long")


QUERIES = {"clean_card_csv": q_clean_card_csv, "event_time": q_event_time, "sample_exact": q_sample_exact, "random_split": q_random_split, "batch_predict": q_batch_predict, "predict_reloaded": q_predict_reloaded,
           "run_records": q_run_records, "ranked_records": q_ranked_records, "alert_records": q_alert_records, "table_fingerprints": q_table_fingerprints,
           "check_reloaded_table": q_check_reloaded_table, "check_stored_params": q_check_stored_params, "model_size": q_model_size}


def mlp_model(spark, sf, epochs: int = 8, percentile: float = 95):
    """2-way flow: standardise on train, fit on normal train rows with the tail 20 % of them as
    validation (C4), threshold at the percentile of the fit rows' scores."""
    from pyspark import StorageLevel

    from vigil.operators.mlp_ae import fit_mlp
    from vigil.operators.split import tail_rows
    from vigil.plans.queries_eval import KEYS, _standardized
    scaler, ft, feats = _standardized(spark, sf)
    z = scaler.transform(ft, keep=KEYS).persist(StorageLevel.MEMORY_AND_DISK)
    normal = z.where((F.col("split") == "train") & (F.col("is_fraudulent") == 0))
    fit_rows = tail_rows(normal, 0.2, order=("row_id",), name="is_val")
    model = fit_mlp(fit_rows, feats, val_col="is_val", epochs=epochs)
    fit_scores = model.score(fit_rows.where(F.col("is_val") == 0))
    model.threshold = E.threshold_at(fit_scores, "anomaly_score", percentile)
    return model, z


def q_mlp_scores(spark, sf):
    model, z = mlp_model(spark, sf)
    s = model.score(z.where(F.col("split") == "test"), keep=("row_id", "is_fraudulent"))
    return rounded(E.predict(s, "anomaly_score", model.threshold))


def q_mlp_auc(spark, sf):
    model, z = mlp_model(spark, sf)
    s = model.score(z.where(F.col("split") == "test"), keep=("row_id", "is_fraudulent"))
    return rounded(E.roc_auc(s, "anomaly_score", "is_fraudulent"))


QUERIES.update({"mlp_scores": q_mlp_scores, "mlp_auc": q_mlp_auc})


def q_mlp_3way_auc(spark, sf, epochs: int = 6):
    """3-way flow (L4 variant + L6): standardise and fit on ALL train rows (fraud included), keep the
    epoch with the best validation AUC on the ``val`` split, report the test AUC."""
    from pyspark import StorageLevel

    from vigil.operators.mlp_ae import fit_mlp
    from vigil.operators.scale import fit_scaler
    from vigil.plans.queries_eval import KEYS
    ft = P.card_features(spark, sf, "80_10_10")[1]
    feats = [c for c in ft.columns if c not in KEYS]
    scaler = fit_scaler(ft.where(F.col("split") == "train"), feats)
    z = scaler.transform(ft, keep=KEYS).persist(StorageLevel.MEMORY_AND_DISK)
    fit_rows = z.where(F.col("split") != "test").withColumn("is_val", (F.col("split") == "val").cast("int"))
    model = fit_mlp(fit_rows, feats, val_col="is_val", val_label="is_fraudulent", epochs=epochs)
    test = model.score(z.where(F.col("split") == "test"), keep=("row_id", "is_fraudulent"))
    auc = E.roc_auc(test, "anomaly_score", "is_fraudulent")
    val_aucs = [h.get("val_auc") for h in model.history if h.get("val_auc") is not None]
    return rounded(auc.withColumns({"best_val_auc": F.lit(max(val_aucs) if val_aucs else None).cast("double"),
                                    "epochs_run": F.lit(len(model.history))}))


QUERIES["mlp_3way_auc"] = q_mlp_3way_auc
