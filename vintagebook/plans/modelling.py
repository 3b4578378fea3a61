"""Preprocessing and reporting compositions (train/test in, DataFrames out).

Fitted state (means, modes, encodings, dropped columns) is returned as
small tables or lists; the data never leaves the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import encode as E
from ..operators import metrics as M
from ..operators import profile as PF
from ..operators import rates as RT


def preprocess_select(df: DataFrame, target: str, key: Sequence[str], corr_threshold: float = 0.5,
                      max_null_pct: float = 70.0, min_var: float | None = 0.1
                      ) -> tuple[DataFrame, list[str], DataFrame]:
    """Drop columns above ``max_null_pct`` nulls -> mean / mode imputation ->
    target encoding of text columns -> low-variance cut -> correlation cut, all
    fitted on and returning every row.  Returns (frame, dropped, profile)."""
    feats = [c for c in df.columns if c != target and c not in key]
    profile = PF.column_profile(df.select(*feats))
    keep_rows = profile.filter(F.col("pct_nulls") <= max_null_pct).select("variable").collect()
    keep = [r["variable"] for r in keep_rows]
    keep = [c for c in feats if c in keep]  # column count, not row count
    num, cat = E.split_numeric_categorical(df.select(*keep))
    base = df.select(*key, target, *keep)
    fit = PF.impute_fit(base, num, cat)
    filled = PF.impute_apply(base, fit)
    if cat:
        te = E.target_encode_fit(filled, cat, target)
        filled = E.target_encode_apply(filled, te, cat)
    feats = num + cat
    dropped: list[str] = []
    if min_var is not None and feats:
        low = [r["variable"] for r in E.low_variance_columns(filled, feats, min_var).collect()]
        dropped += low
        feats = [c for c in feats if c not in low]
    if len(feats) > 1:
        corr = E.correlated_to_drop(filled, feats, corr_threshold)
        dropped += corr
        feats = [c for c in feats if c not in corr]
    return filled.select(*key, target, *feats), sorted(set(dropped)), profile


def dataprep(train: DataFrame, test: DataFrame, target: str, key: Sequence[str],
             corr_threshold: float = 0.5) -> tuple[DataFrame, DataFrame, dict]:
    """split -> impute (fit on train) -> target-encode (fit on train) -> correlation cut."""
    feats = [c for c in train.columns if c != target and c not in key]
    num, cat = E.split_numeric_categorical(train.select(*feats))
    tr, te, imp = PF.impute_train_test(train, test, num, cat)
    enc = None
    if cat:
        enc = E.target_encode_fit(tr, cat, target)
        tr = E.target_encode_apply(tr, enc, cat)
        te = E.target_encode_apply(te, enc, cat)
    cols = num + cat
    tr_out, te_out, dropped = E.drop_correlated(tr, te, cols, corr_threshold) if len(cols) > 1 \
        else (tr, te, [])
    return tr_out, te_out, {"num_cols": num, "cat_cols": cat, "imputer": imp, "encoder": enc,
                            "dropped_corr_cols": dropped}


def column_transformer(train: DataFrame, test: DataFrame, target: str, key: Sequence[str],
                       low_card: Sequence[str], high_card: Sequence[str], numeric: Sequence[str]
                       ) -> tuple[DataFrame, DataFrame]:
    """Low-cardinality text: mode + one-hot; high-cardinality text: mode +
    target encoding; numerics: median + robust scaling.  Fit on train only."""
    imp = PF.impute_fit(train, numeric, [*low_card, *high_card], strategy="median")
    tr, te = PF.impute_apply(train, imp), PF.impute_apply(test, imp)
    if high_card:
        enc = E.target_encode_fit(tr, high_card, target)
        tr, te = E.target_encode_apply(tr, enc, high_card), E.target_encode_apply(te, enc, high_card)
    if low_card:
        oh = E.one_hot_fit(tr, low_card)
        tr, te = E.one_hot_apply(tr, oh, low_card), E.one_hot_apply(te, oh, low_card)
    if numeric:
        sc = E.robust_scale_fit(tr, numeric)
        tr, te = E.scale_apply(tr, sc), E.scale_apply(te, sc)
    return tr, te


def model_report(scored: DataFrame, score: str, label: str, split: str = "split") -> dict[str, DataFrame]:
    """Tables behind the model report: event rate per split, confusion metrics,
    ROC and PR curves, Gini / AUC, KS and jittered decile ordering."""
    from ..operators.model import noise_jitter_deciles
    return {
        "event_rate": RT.event_rate_by_vintage(scored, label, split),
        "confusion": M.confusion_metrics(scored, score, label, group_cols=[split]),
        "roc": M.roc_curve_table(scored, score, label, [split]),
        "pr": M.pr_curve_table(scored, score, label, [split]),
        "auc": M.roc_auc(scored, score, label, [split]),
        "ks": M.ks_statistic(scored, score, label, [split]),
        "deciles": noise_jitter_deciles(scored, score, label),
    }
