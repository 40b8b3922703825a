"""The minimum end-to-end back-test and its reusable pieces.

Question: which of two zero-shot models forecasts daily orders per nation
better over the held-out last 14 days? panel -> splits -> contexts ->
forecasts (weekly naive, last value) -> one scorer -> ranking.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..config import PanelConfig, fingerprint
from ..functions import scalar
from ..operators import compare, contexts, panel, score
from ..operators.forecast import zero_shot
from ..schemas import PREDICTIONS, conform
from ..session import shared_path
from ..sources import adapters, scans
from ..sources.scans import actuals
from ..sources.tables import bucket_count, code_version, ensure_table, input_identity, table_properties
from .common import CONFIGS, rounded


def prepped_for(spark: SparkSession, sf_dir: str, adapter: str = "nation", cfg: PanelConfig | None = None) -> DataFrame:
    """The prepped panel over the stored source table: every model, the actuals
    and the scorer read it without another pass over the facts. The table is
    written once per configuration, input files and code (its fingerprint covers
    them), bucketed by series and in order of series and day, so that contexts,
    fits and per-series scores need no exchange and no sort; the last day, observed by the write, gives the splits' cut-off."""
    cfg = cfg or CONFIGS[adapter]
    path = source_path(spark, sf_dir, adapter, cfg)
    source = source_for(spark, sf_dir, adapter, cfg, path)
    last = table_properties(spark, path)["last_day"]
    return panel.build_prepped(source, cfg, max_day=F.lit(last).cast("date"))


#: The code that a stored source table depends on.
BUILD_CODE = (panel, adapters, scans, scalar, schemas)


def source_fingerprint(spark: SparkSession, sf_dir: str, adapter: str, cfg: PanelConfig) -> str:
    payload = {
        "adapter": adapter, "config": cfg.source_fields(), "code": code_version(*BUILD_CODE), "layout": "series buckets by series and day, last day",
        "inputs": input_identity(spark, *adapters.input_paths(sf_dir, adapter)),
    }
    return fingerprint(payload, 24)


def source_path(spark: SparkSession, sf_dir: str, adapter: str, cfg: PanelConfig) -> str:
    return shared_path(spark, "tables", f"source-{adapter}-{source_fingerprint(spark, sf_dir, adapter, cfg)}")


def source_for(spark: SparkSession, sf_dir: str, adapter: str, cfg: PanelConfig, path: str | None = None) -> DataFrame:
    path = path or source_path(spark, sf_dir, adapter, cfg)
    trips, weather_raw, meta, _ = adapters.adapter_inputs(spark, sf_dir, adapter)
    s, t = cfg.series_column, cfg.time_column
    return ensure_table(
        spark, path, path.rsplit("-", 1)[1], lambda: panel.build_source(trips, weather_raw, meta, cfg, buckets=bucket_count(spark)),
        observed={"last_day": F.max(t)}, cluster_by=s, sort_by=t, laid=True,
    )[0]


def counts_for(spark: SparkSession, sf_dir: str, adapter: str) -> DataFrame:
    """(series, n_rows) of every valid series, stored once per input like the source table."""
    trips, _, _, cfg = adapters.adapter_inputs(spark, sf_dir, adapter)
    inputs = input_identity(spark, *adapters.input_paths(sf_dir, adapter, covariates=False))
    fp = fingerprint({"adapter": adapter, "counts": True, "code": code_version(*BUILD_CODE), "inputs": inputs}, 24)
    build = lambda: panel.top_series(trips, cfg.replace(top_n=None))
    return ensure_table(spark, shared_path(spark, "tables", f"counts-{adapter}-{fp}"), fp, build)[0]


def zero_shot_predictions(prepped: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Weekly seasonal naive and last value from one contexts plan in one pass."""
    ctx = contexts.series_contexts(prepped, cfg)
    return conform(
        zero_shot.seasonal_naive_models(ctx, cfg.horizon, {"seasonal_naive": 7, "last_value": 1}), PREDICTIONS
    )


def backtest(prepped: DataFrame, preds: DataFrame, cfg: PanelConfig) -> DataFrame:
    return compare.rank_models(score.evaluate_checked(preds, actuals(prepped, cfg)))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = CONFIGS["nation"]
    prepped = prepped_for(spark, sf_dir, "nation", cfg)
    return rounded(backtest(prepped, zero_shot_predictions(prepped, cfg), cfg))
