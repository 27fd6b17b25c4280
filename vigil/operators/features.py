"""Fit / transform of the feature set (2.D-2.K) as an Estimator-like pair.

``FeatureModel.fit(train)`` runs
  * one quantile pass (amount and quantity percentiles, robust scalers),
  * one aggregate for hour statistics,
  * one by-key pass for every categorical lookup (codes, location counts,
    category fraud rates) - pre-aggregated, so a hot category is one row.
The dictionaries stay distributed tables of any size: codes are ranks over the
distinct categories. ``transform`` is a chain of ``withColumns`` blocks; a lookup
is a broadcast join where the dictionary's bytes, summed at fit time, are few,
else a shuffled join beside which hot categories are looked up by broadcast. Batch statistics (J6, J9) are computed per batch in one grouped
aggregate, or taken from the fit (``batch_stats="fitted"``, used for streams).
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions import amount as amt_f
from vigil.functions import behavior as beh_f
from vigil.functions import customer as cust_f
from vigil.functions import interact as int_f
from vigil.functions import risk as risk_f
from vigil.functions import temporal as tmp_f
from vigil.functions.clean import V_COLUMNS, is_card
from vigil.operators.rank import global_rank
from vigil.operators.select import exact_quantiles, quantile_table
from vigil.session import apply_wide_plan_conf, checkpoint

GROUPS = ("amount", "temporal", "customer", "behavioral", "velocity", "interaction", "risk")
PROBS = [0.25, 0.5, 0.75, 0.9, 0.95]
BROADCAST_BYTES = 32 << 20  # dictionaries up to this are broadcast
HOT_SHARE = 1 / 1024        # categories of at least this share are hot: 1024 a column at most
BROADCAST_BATCHES = 10_000  # of about 60 numbers each
DROP_CATEGORICAL = ["payment_method", "product_category", "device_used", "age_group", "customer_location"]
DROP_DATES = ["timestamp", "transaction_date"]
TARGET = "is_fraudulent"
BATCH = "_batch"


class UnfittedError(RuntimeError):
    pass


@dataclass
class FeatureModel:
    groups: tuple = GROUPS
    amount_col: str | None = None
    rare_location_max: float = 5
    handle_invalid: str = "error"          # or "keep" (unseen code -> null -> 0)
    batch_stats: str = "batch"             # or "fitted"
    late_night: tuple = tmp_f.LATE_NIGHT
    business_hours: tuple = tmp_f.BUSINESS_HOURS
    business_weekdays_only: bool = False

    def fit(self, train: DataFrame, held: bool = False) -> "FittedFeatures":
        """``held``: the rows are in memory or on disk, so no copy of the columns that are read several times is held."""
        card = is_card(train)
        amt = self.amount_col or ("amount" if card else "transaction_amount")
        _check_groups(self, card, train.columns)
        params: dict = {"card": card, "amount_col": amt}
        qcols = [c for c in (amt, "quantity") if c in train.columns and (c == amt or not card)]
        extra = {}
        if "transaction_date" in train.columns:
            h = F.hour("transaction_date")
            extra = {"hour_mean": F.avg(h), "hour_std": F.stddev_samp(h), "day_weekend_ratio": F.avg(flag_weekend())}
        q = exact_quantiles(train, qcols, PROBS, extra=extra, held=held)[()]
        params.update(q.get("extra", {}))
        for c, prefix in ((amt, "amount"), ("quantity", "quantity")):
            if c not in q:
                continue
            vals = dict(zip(PROBS, q[c]))
            params[f"{prefix}_25"] = vals[0.25]
            for p in (50, 75, 90, 95):
                params[f"{prefix}_{p}"] = vals[p / 100]
            spread = (vals[0.75] - vals[0.25]) if vals[0.75] is not None else 0.0
            params[f"{prefix}_center"] = vals[0.5]
            params[f"{prefix}_scale"] = spread if spread else 1.0
        encodings, sizes = _fit_encodings(train, card, self.groups)
        fitted = FittedFeatures(self, params, encodings, sizes=sizes)
        if self.batch_stats == "fitted" and card:
            stats = _batch_stats(fitted._pre_risk(train.withColumn(BATCH, F.lit(0))), V_COLUMNS, train.columns).drop(BATCH).first()
            fitted.fitted_batch = stats.asDict() if stats else {}
        return fitted


def flag_weekend():
    return (F.weekday("transaction_date") >= 5).cast("int")


def _check_groups(model: FeatureModel, card: bool, cols) -> None:
    g = set(model.groups)
    if not card and "risk" in g:
        need = {"amount", "temporal", "customer", "behavioral", "velocity"}
        if not need <= g:
            raise ValueError(f"shop risk flags need feature groups {sorted(need - g)}")
    if card and "risk" in g and not {"amount", "temporal"} <= g:
        raise ValueError("card risk flags need the amount and temporal groups")


def _encoded_columns(train: DataFrame, card: bool, groups) -> list[tuple[str, Column]]:
    cols = []
    if card or "customer" not in groups:
        return cols
    if "customer_age" in train.columns:
        cols.append(("age_group", cust_f.age_group(F.col("customer_age"))))
    for c in ["customer_location", *cust_f.CATEGORICAL]:
        if c in train.columns:
            cols.append((c, F.col(c).cast("string")))
    return cols


def _fit_encodings(train: DataFrame, card: bool, groups) -> tuple[DataFrame | None, dict]:
    """Rows ``(column, category, code, freq, share, fraud_rate)`` from one grouped pass, and the bytes of each
    column's dictionary. A code is the category's rank in its column (code points); a null category has none."""
    enc = _encoded_columns(train, card, groups)
    leftovers = [f.name for f in train.schema.fields
                 if isinstance(f.dataType, T.StringType) and f.name not in DROP_CATEGORICAL + DROP_DATES
                 and f.name != TARGET]
    enc += [(c, F.col(c)) for c in leftovers]
    if not enc:
        return None, {}
    label = F.col(TARGET).cast("double") if TARGET in train.columns else F.lit(None).cast("double")
    stacked = train.select(label.alias("_y"), F.posexplode(F.array(*[expr for _, expr in enc])).alias("_i", "category"))
    name = F.element_at(F.array(*[F.lit(name) for name, _ in enc]), F.col("_i") + 1)
    agg = (stacked.groupBy("_i", "category").agg(F.count(F.lit(1)).alias("freq"), F.avg("_y").alias("fraud_rate"))
           .select(name.alias("column"), "category", "freq", "fraud_rate"))
    # nulls sort first, so a column's codes start behind its null category
    ranked = checkpoint(global_rank(agg, ["column", "category"], "_rank"))
    per = ranked.groupBy("column").agg(
        F.sum("freq").alias("_n"), F.min(F.when(F.col("category").isNotNull(), F.col("_rank"))).alias("_first"),
        F.sum(F.coalesce(F.octet_length("category"), F.lit(0)) + ENTRY_BYTES).alias("_bytes")).collect()  # a row per column
    bounds = train.sparkSession.createDataFrame([(r["column"], r["_n"], r["_first"]) for r in per],
                                                "column string, _n long, _first long")
    code = F.when(F.col("category").isNotNull(), F.col("_rank") - F.col("_first")).cast("int")
    table = ranked.join(F.broadcast(bounds), "column").select(
        "column", "category", code.alias("code"), "freq", (F.col("freq") / F.col("_n")).alias("share"), "fraud_rate")
    return table, {r["column"]: r["_bytes"] for r in per}


ENTRY_BYTES = 64  # of a dictionary's row beside its category
ENC_SCHEMA = T.StructType([
    T.StructField("column", T.StringType()), T.StructField("category", T.StringType()),
    T.StructField("code", T.IntegerType()), T.StructField("freq", T.LongType()),
    T.StructField("share", T.DoubleType()), T.StructField("fraud_rate", T.DoubleType())])


def _batch_stats(df: DataFrame, vs_all, cols) -> DataFrame:
    """Per batch (``BATCH``): mean and sample std of each v, and the q95 of the v mean and std."""
    vs = [v for v in vs_all if v in cols]
    moments = {f"{name}_{v}": f(v) for v in vs for name, f in (("mean", F.avg), ("std", F.stddev_samp))}
    q = quantile_table(df, ["v_features_mean", "v_features_std"], [0.95], by=[BATCH], extra=moments)
    return q.withColumns({"q95_v_mean": F.col("v_features_mean")[0], "q95_v_std": F.col("v_features_std")[0]}).drop("v_features_mean", "v_features_std")


@dataclass
class FittedFeatures:
    model: FeatureModel
    params: dict
    encodings: DataFrame | None = None      # ENC_SCHEMA
    fitted_batch: dict | None = None
    sizes: dict = field(default_factory=dict)  # bytes of each column's dictionary

    # -- lookups -----------------------------------------------------------
    def _lookup(self, df: DataFrame, column: str, src, want: dict[str, str]) -> DataFrame:
        """Left lookup of ``want`` (enc field -> output name) for category ``src``.

        A dictionary that is too large to broadcast is joined by shuffle. Rows of its hot categories are looked up
        by broadcast before; they and rows without a category get a salt that no entry has, so they spread."""
        key = f"_k_{column}"
        names = list(want.values())
        df = df.withColumn(key, src)
        if column not in self.sizes:
            return df.withColumns({v: F.lit(None).cast(ENC_SCHEMA[k].dataType) for k, v in want.items()})
        enc = self.encodings.where((F.col("column") == column) & F.col("category").isNotNull())
        enc = enc.select(F.col("category").alias(key), "share" if "share" not in want else F.col("share").alias(want["share"]),
                         *[F.col(k).alias(v) for k, v in want.items() if k != "share"])
        share = F.col(want.get("share", "share"))
        if self.sizes[column] <= BROADCAST_BYTES:
            return df.join(F.broadcast(enc.select(key, *names)), key, "left")
        hot = enc.where(share >= HOT_SHARE).select(key, *[F.col(n).alias(f"_hot{n}") for n in names], F.lit(True).alias("_hot"))
        cold = enc.where(share < HOT_SHARE).select(key, *names, F.lit(0).cast("long").alias("_salt"))
        row = [F.col(f.name) for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
        df = df.join(F.broadcast(hot), key, "left")
        df = df.withColumn("_salt", F.when(F.col("_hot") | F.col(key).isNull(), F.xxhash64(*row)).otherwise(F.lit(0).cast("long")))
        df = df.join(cold, [key, "_salt"], "left")
        return df.withColumns({n: F.coalesce(F.col(f"_hot{n}"), F.col(n)) for n in names}).drop("_hot", "_salt", *[f"_hot{n}" for n in names])

    def _code(self, name: str, src) -> F.Column:
        code = F.col(name)
        if self.model.handle_invalid == "error":
            return F.when(code.isNull() & src.isNotNull(),
                          F.raise_error(F.concat(F.lit(f"unseen label in {name}: "), src.cast("string")))
                          ).otherwise(code)
        return code

    # -- transform ---------------------------------------------------------
    def _pre_risk(self, df: DataFrame) -> DataFrame:
        p, m = self.params, self.model
        amt = p["amount_col"]
        g = set(m.groups)
        card = p["card"]
        vs = [v for v in V_COLUMNS if v in df.columns] if card else []
        if "amount" in g:
            df = df.withColumns(amt_f.amount_columns(amt, p))
            if vs:
                df = df.withColumns(amt_f.v_stat_columns(vs))
                df = df.withColumns({
                    "v_features_std": amt_f.v_std_column(vs),
                    "v_features_range": F.col("v_features_max") - F.col("v_features_min")})
                df = df.withColumns({
                    "amount_v_mean_interaction": F.col(amt) * F.col("v_features_mean"),
                    "amount_v_std_interaction": F.col(amt) * F.col("v_features_std")}).drop("_v_cnt")
                base = [c for c in df.columns if c not in amt_f.V_ORDER]
                df = df.select(*base, *amt_f.V_ORDER)
        if "temporal" in g and "transaction_date" in df.columns:
            df = df.withColumns(tmp_f.temporal_columns("transaction_date", p, m.late_night, m.business_hours,
                                                       m.business_weekdays_only))
        if not card and "customer" in g:
            df = self._customer(df)
        if not card and "behavioral" in g and {"quantity", "account_age_days"} <= set(df.columns):
            df = df.withColumns(beh_f.behavior_columns(amt, p))
        if not card and "velocity" in g and {"quantity", "account_age_days"} <= set(df.columns):
            df = df.withColumns(beh_f.velocity_columns(amt, p))
        if "interaction" in g:
            if card:
                df = df.withColumns(int_f.card_interactions(amt, vs))
            else:
                df = df.withColumns(int_f.shop_interactions(amt, set(df.columns)))
        return df

    def _customer(self, df: DataFrame) -> DataFrame:
        m = self.model
        cols = set(df.columns)
        if "customer_age" in cols:
            df = df.withColumn("age_group", cust_f.age_group(F.col("customer_age")))
            df = self._lookup(df, "age_group", F.col("age_group"), {"code": "_code_age"})
            df = df.withColumn("age_group_encoded", self._code("_code_age", F.col("age_group")))
            df = df.drop("_code_age", "_k_age_group").withColumns(cust_f.age_columns())
        if "account_age_days" in cols:
            df = df.withColumns(cust_f.account_columns())
        if "customer_location" in cols:
            df = self._lookup(df, "customer_location", F.col("customer_location"),
                              {"freq": "_lf", "share": "_ls"})
            df = df.withColumns({
                "location_freq": F.coalesce(F.col("_lf").cast("double"), F.lit(0.0)),
                "location_risk_score": F.coalesce(F.col("_ls"), F.lit(0.0))}).drop("_lf", "_ls",
                                                                                  "_k_customer_location")
            df = df.withColumn("rare_location", (F.col("location_freq") <= m.rare_location_max).cast("int"))
        for c in cust_f.CATEGORICAL:
            if c not in cols:
                continue
            df = self._lookup(df, c, F.col(c), {"code": f"_c_{c}", "fraud_rate": f"_r_{c}"})
            df = df.withColumns({
                f"{c}_encoded": self._code(f"_c_{c}", F.col(c)),
                f"{c}_fraud_rate": F.coalesce(F.col(f"_r_{c}"), F.lit(0.0))}).drop(f"_c_{c}", f"_r_{c}",
                                                                                    f"_k_{c}")
        return df

    def transform(self, df: DataFrame, batch_col: str | None = None,
                  keep: tuple = ("row_id",)) -> DataFrame:
        """Feature table: ``keep`` columns (and the batch column) followed by the features."""
        apply_wide_plan_conf(df.sparkSession)
        p, m = self.params, self.model
        g = set(m.groups)
        card = p["card"]
        amt = p["amount_col"]
        df = df.withColumn(BATCH, F.col(batch_col) if batch_col else F.lit(0))
        df = self._pre_risk(df)
        vs = [v for v in V_COLUMNS if v in df.columns] if card else []
        if "risk" in g:
            if card:
                df = self._card_risk(df, amt, vs)
            else:
                df = df.withColumns(risk_f.shop_risk(amt, p))
                df = df.withColumn("comprehensive_risk_score", risk_f.shop_score()).withColumns(risk_f.bands())
        return self._finalize(df, batch_col, keep)

    def _card_risk(self, df: DataFrame, amt: str, vs: list[str]) -> DataFrame:
        p = self.params
        if not vs:
            df = df.withColumns(risk_f.card_risk_first(amt, p, vs, {}))
            return df.withColumn("comprehensive_risk_score", risk_f.card_score(vs, {})).withColumns(
                risk_f.bands())
        if self.fitted_batch is not None:
            names = list(self.fitted_batch)
            df = df.withColumns({f"_bs_{n}": F.lit(v).cast("double") for n, v in self.fitted_batch.items()})
        else:
            stats = _batch_stats(df, vs, df.columns)
            names = [c for c in stats.columns if c != BATCH]
            rows = stats.limit(BROADCAST_BATCHES + 1).collect()
            small = len(rows) <= BROADCAST_BATCHES  # a row per batch; computed once for all uses of the features
            stats = df.sparkSession.createDataFrame(rows, stats.schema) if small else checkpoint(stats)
            stats = stats.select(F.col(BATCH).alias("_bk"), *[F.col(n).alias(f"_bs_{n}") for n in names])
            df = df.join(F.broadcast(stats) if small else stats, F.col(BATCH).eqNullSafe(F.col("_bk")), "left").drop("_bk")
        batch = {n: F.col(f"_bs_{n}") for n in names}
        df = df.withColumns(risk_f.card_risk_first(amt, p, vs, batch))
        df = df.withColumn("comprehensive_risk_score", risk_f.card_score(vs, batch)).withColumns(risk_f.bands())
        return df.drop(*[f"_bs_{n}" for n in names])

    def _finalize(self, df: DataFrame, batch_col: str | None, keep: tuple) -> DataFrame:
        """K1-K4: drop encoded categoricals and dates, encode leftovers, drop target, fill 0."""
        df = df.drop(*[c for c in DROP_CATEGORICAL + DROP_DATES if c in df.columns])
        df = df.drop(*[c for c in df.columns if c.startswith("_k_")])
        keep_cols = [c for c in keep if c in df.columns]
        if batch_col and batch_col not in keep_cols:
            keep_cols.append(batch_col)
        leftovers = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)
                     and f.name not in keep_cols and f.name not in (BATCH, TARGET)]
        for c in leftovers:
            df = self._lookup(df, c, F.col(c), {"code": f"_c_{c}"})
            df = df.withColumn(c, self._code(f"_c_{c}", F.col(c))).drop(f"_c_{c}", f"_k_{c}")
        feats = [c for c in df.columns if c not in keep_cols and c not in (TARGET, BATCH)]
        numeric_fill = {c: 0 for c in feats}
        out = df.select(*keep_cols, *feats)
        return out.na.fill(0, subset=list(numeric_fill))

    def feature_names(self, df: DataFrame, keep: tuple = ("row_id",)) -> list[str]:
        return [c for c in self.transform(df, keep=keep).columns if c not in keep]

    # -- persistence (A8) --------------------------------------------------
    def save(self, spark: SparkSession, path: str) -> None:
        if self.encodings is not None:
            table = checkpoint(self.encodings)  # it may have been loaded from the folder that is written anew
            table.write.mode("overwrite").parquet(os.path.join(path, "encodings"))
        spark.createDataFrame([(json.dumps(self.params), json.dumps(self.model.__dict__, default=list),
                                json.dumps(self.fitted_batch), json.dumps(self.sizes))], "params string, model string, batch string, sizes string") \
            .coalesce(1).write.mode("overwrite").parquet(os.path.join(path, "params"))

    @staticmethod
    def load(spark: SparkSession, path: str) -> "FittedFeatures":
        r = spark.read.parquet(os.path.join(path, "params")).first()
        if r is None:
            raise UnfittedError(f"no fitted feature state at {path}")
        md = json.loads(r["model"])
        for k in ("groups", "late_night", "business_hours"):
            md[k] = tuple(md[k])
        sizes = json.loads(r["sizes"])
        enc = spark.read.schema(ENC_SCHEMA).parquet(os.path.join(path, "encodings")) if sizes else None
        batch = json.loads(r["batch"]) if r["batch"] else None
        return FittedFeatures(FeatureModel(**md), json.loads(r["params"]), enc, batch, sizes)


Column = F.Column
