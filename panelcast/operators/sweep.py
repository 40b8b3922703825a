"""Design-of-experiments sweep (EX1-EX5).

EX1 ``doe_grid``      every combination of the configured axes. An axis is a full
                       configuration path of ``AXES``; each combination is built as
                       a ``PanelConfig``, so its values are validated like any other.
EX2 ``variant_label`` ``horizon7-top_n10`` / ``base``: last path segment + value.
EX3 ``sweep_scores``  one plan for models that need no fit. Contexts are built once per distinct
                       cut date and series, then fanned out to the variants that share it; a
                       variant's own horizon and top-N apply to arrays and forecasts, never to
                       copies of the panel.
EX3 ``run_sweep``     any models, fitted ones too: each variant's panel, every model, the shared
                       scorer. The driver loops over configuration rows only; each step is a Spark job.
EX4/EX5 run records (parameters, overrides, metrics), the run's configuration and its predictions:
                       ``run_records`` / ``write_run_log`` / ``write_artifacts``.
"""

from __future__ import annotations

import dataclasses
import itertools
import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import TEST, PanelConfig, fingerprint
from ..functions.scalar import slug_value
from ..schemas import PREDICTIONS
from .compare import rank_models
from .panel import top_series
from .score import evaluate_checked

#: Axis path -> the configuration field it sets.
AXES = {
    "data.station_filter.top_n": "top_n",
    "data.splits.test_length": "test_length",
    "data.splits.validate_length": "validate_length",
    "forecast.horizon": "horizon",
    "forecast.context_len": "context_len",
}

Model = Callable[[DataFrame, PanelConfig], DataFrame]


# -- EX1 + EX2 -----------------------------------------------------------------
def variant_configs(axes: Mapping[str, Sequence], cfg: PanelConfig) -> list[tuple[list[str], list[str], PanelConfig]]:
    """(paths, values as text, configuration) of every combination; no axes: the base configuration alone."""
    unknown = [a for a in axes if a not in AXES]
    if unknown:
        raise ValueError(f"no such axis: {', '.join(unknown)}; known: {', '.join(AXES)}")
    empty = [a for a, values in axes.items() if not list(values)]
    if empty:
        raise ValueError(f"axis without values: {', '.join(empty)}")
    out = []
    for combo in itertools.product(*axes.values()):
        for path, v in zip(axes, combo):
            if not (isinstance(v, int) and not isinstance(v, bool)) and not (v is None and AXES[path] == "top_n"):
                raise ValueError(f"{path}: {v!r} is no whole number")
        over = {AXES[path]: v for path, v in zip(axes, combo)}
        out.append((list(axes), [str(v) for v in combo], cfg.replace(**over)))
    return out


def doe_grid(spark: SparkSession, axes: Mapping[str, Sequence], cfg: PanelConfig) -> DataFrame:
    """One row per combination: variant label + the effective parameters (``top_n`` NULL: every series)."""
    rows = [
        (paths, values, c.top_n, c.horizon, c.test_length, c.validate_length, c.context_len)
        for paths, values, c in variant_configs(axes, cfg)
    ]
    ints = ("top_n", "horizon", "test_length", "validate_length", "context_len")
    schema = T.StructType(
        [
            T.StructField("axis_paths", T.ArrayType(T.StringType())),
            T.StructField("axis_values", T.ArrayType(T.StringType())),
            *[T.StructField(c, T.IntegerType()) for c in ints],
        ]
    )
    return spark.createDataFrame(rows, schema).withColumn("variant", variant_label("axis_paths", "axis_values"))


def variant_label(paths: str, values: str) -> F.Column:
    parts = F.transform(
        F.arrays_zip(F.col(paths).alias("p"), F.col(values).alias("v")),
        lambda z: F.concat(F.element_at(F.split(z["p"], r"\."), -1), slug_value(z["v"])),
    )
    return F.when(F.size(paths) == 0, F.lit("base")).otherwise(F.array_join(parts, "-"))


# -- EX3: models without a fit, one plan ------------------------------------------
def _keeps(v, rank: str = "volume_rank") -> F.Column:
    return v["top_n"].isNull() | (F.col(rank) <= v["top_n"])


def sweep_panel(
    trips: DataFrame, prepped_max: DataFrame, grid: DataFrame, cfg: PanelConfig, counts: DataFrame | None = None
) -> tuple[DataFrame, list]:
    """(panel rows with the series' volume rank; the variants as dictionaries, each with its ``cut``: the last day
    before its TEST window).

    ``prepped_max`` must be a panel of the grid's largest top-N (or more): the call raises and names the first series it
    lacks, so that no variant is silently short. ``counts`` (series, n_rows) saves another pass over the facts.
    """
    rows = grid.collect()  # configuration rows, not data
    tops = [r["top_n"] for r in rows]
    largest = None if None in tops else max(tops)
    top = top_series(trips, cfg.replace(top_n=largest)) if counts is None else counts
    if counts is not None and largest is not None:
        top = counts.orderBy(F.desc("n_rows"), F.asc("series")).limit(largest)
    s, t, y = cfg.series_column, cfg.time_column, cfg.target_column
    panel = prepped_max.select(F.col(s).alias("series"), F.col(t).alias("date"), F.col(y).cast("double").alias("y"))
    last = panel.groupBy("series").agg(F.max("date").alias("last"))  # one row per series
    short = top.select("series").join(last, "series", "left_anti").orderBy("series").take(1)
    if short:
        raise ValueError(f"the panel lacks series {short[0]['series']!r}, which a variant of the grid keeps")
    # at most the largest number's rows: the one window without partitions is bounded by configuration; of the others (where a
    # variant keeps every series) no rank is asked
    by_volume = Window.orderBy(F.desc("n_rows"), F.asc("series"))
    bound = max([n for n in tops if n is not None], default=0)
    ranked = top.orderBy(F.desc("n_rows"), F.asc("series")).limit(bound)
    ranked = ranked.select("series", F.row_number().over(by_volume).alias("volume_rank"))
    if largest is None:
        ranks = top.select("series").join(ranked, "series", "left").select("series", F.coalesce("volume_rank", F.lit(bound + 1)).alias("volume_rank"))
    else:
        ranks = ranked
    literal = F.array(
        *[F.struct(F.lit(r["variant"]).alias("variant"), F.lit(r["top_n"]).cast("int").alias("top_n")) for r in rows]
    )
    ends = last.join(ranks, "series").select("last", F.explode(F.filter(literal, lambda v: _keeps(v))).alias("v"))
    ends = {r["variant"]: r["last"] for r in ends.groupBy("v.variant").agg(F.max("last").alias("last")).collect()}
    variants = [{**r.asDict(), "cut": ends[r["variant"]] - _days(r["test_length"])} for r in rows]
    return panel.join(ranks, "series"), variants


def _days(n: int):
    import datetime

    return datetime.timedelta(days=n)


def _variant_array(variants: list, cut: F.Column, extra=lambda v: F.lit(True)) -> F.Column:
    """The variants (a literal: configuration) that have this cut date and keep the row's series."""
    one = lambda v: F.struct(
        F.lit(v["variant"]).alias("variant"), F.lit(v["top_n"]).cast("int").alias("top_n"),
        F.lit(v["horizon"]).alias("horizon"), F.lit(v["context_len"]).alias("context_len"), F.lit(v["cut"]).alias("cut"),
    )
    return F.filter(F.array(*[one(v) for v in variants]), lambda v: (v["cut"] == cut) & _keeps(v) & extra(v))


def sweep_naive(panel: DataFrame, variants: list, periods: dict[str, int]) -> DataFrame:
    """Seasonal-naive forecasts per (variant, series), from one context per (cut date, context length, series)."""
    from .contexts import series_contexts
    from .forecast.zero_shot import seasonal_naive_models

    cfg = PanelConfig(series_column="series", time_column="date", target_column="y")
    out = None
    for length in sorted({v["context_len"] for v in variants}):
        own = [v for v in variants if v["context_len"] == length]
        cuts = F.array(*[F.lit(c) for c in sorted({v["cut"] for v in own})])
        hist = panel.select("series", "date", "y", "volume_rank", F.explode(F.filter(cuts, lambda c: F.col("date") <= c)).alias("cut"))
        ctx = series_contexts(hist.withColumn("splits", F.lit("TRAIN")), cfg, length, keys=("cut", "volume_rank"))
        fan = ctx.select("series", "context", "last_date", "n", F.explode(_variant_array(own, F.col("cut"))).alias("v"))
        fan = fan.select("series", "context", "last_date", "n", "v.variant", "v.horizon")
        fc = seasonal_naive_models(fan, max(v["horizon"] for v in own), periods, keys=("variant",), horizon_col="horizon")
        out = fc if out is None else out.unionByName(fc)
    return out


def sweep_actuals(panel: DataFrame, variants: list) -> DataFrame:
    """(variant, series, date, actual): each variant's held-out days."""
    first = min(v["cut"] for v in variants)
    cuts = F.array(*[F.lit(c) for c in sorted({v["cut"] for v in variants})])
    late = panel.where(F.col("date") > F.lit(first)).select(
        "series", "date", "y", "volume_rank", F.explode(F.filter(cuts, lambda c: F.col("date") > c)).alias("cut")
    )
    held = late.select("series", "date", "y", F.explode(_variant_array(variants, F.col("cut"))).alias("v"))
    return held.select("v.variant", "series", "date", F.col("y").alias("actual"))


def sweep_scores(preds: DataFrame, actuals: DataFrame) -> DataFrame:
    """Metrics per (variant, model) against each variant's own held-out days,
    then ranked within each variant (two variants never share a winner)."""
    return rank_models(evaluate_checked(preds, actuals, ("variant", "model")), by=("variant",))


# -- EX3: any model ---------------------------------------------------------------
def run_sweep(
    panel_of: Callable[[PanelConfig], DataFrame], axes: Mapping[str, Sequence], cfg: PanelConfig, models: Mapping[str, Model],
    experiment: str, root: str,
) -> DataFrame:
    """Every model on every variant's own panel; returns the run log of the experiment.

    ``panel_of`` gives the (written) prepped panel of a configuration, ``models`` map a name to (panel, configuration) ->
    long predictions. Predictions, configuration and records are written below ``root``.
    """
    from ..sources.scans import actuals

    for paths, values, c in variant_configs(axes, cfg):
        prepped = panel_of(c)
        spark = prepped.sparkSession
        row = spark.createDataFrame([(paths, values)], "axis_paths array<string>, axis_values array<string>")
        label = row.select(variant_label("axis_paths", "axis_values")).first()[0]
        preds = None
        for name, model in models.items():
            p = model(prepped, c).withColumn("model", F.lit(name))
            preds = p if preds is None else preds.unionByName(p)
        preds = write_artifacts(preds, c, experiment, label, root)
        ranked = rank_models(evaluate_checked(preds, actuals(prepped, c))).withColumn("variant", F.lit(label))
        grid = row.withColumn("variant", F.lit(label))
        write_run_log(run_records(ranked, grid, experiment, c), f"{root}/runs")
    return read_run_log(spark, f"{root}/runs", experiment)


# -- EX4 / EX5 ----------------------------------------------------------------
def parameters(cfg: PanelConfig) -> dict[str, str]:
    """The configuration as flat text pairs."""
    out: dict[str, str] = {}

    def walk(prefix: str, value) -> None:
        if isinstance(value, dict):
            for k, v in value.items():
                walk(f"{prefix}.{k}" if prefix else k, v)
        else:
            out[prefix] = json.dumps(value, default=str)

    walk("", dataclasses.asdict(cfg))
    return out


def run_records(ranked: DataFrame, grid: DataFrame, experiment: str, cfg: PanelConfig | None = None) -> DataFrame:
    """Run-record rows: run name, model, overrides map, parameters map, metrics map."""
    over = F.map_from_arrays(F.col("axis_paths"), F.col("axis_values"))
    metrics = F.create_map(
        *[x for m in ("mae", "rmse", "smape", "quantile_loss", "n_points") for x in (F.lit(m), F.col(m).cast("double"))]
    )
    pairs = [F.lit(x) for kv in (parameters(cfg) if cfg else {}).items() for x in kv]
    params = F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,string>")
    g = grid.select("variant", over.alias("overrides"))
    return ranked.join(F.broadcast(g), "variant").select(  # a row per variant: configuration
        F.lit(experiment).alias("experiment"),
        F.concat_ws("__", F.lit(experiment), F.col("variant"), F.col("model")).alias("run"),
        "variant",
        "model",
        "overrides",
        params.alias("parameters"),
        metrics.alias("metrics"),
        "rank",
        "winner",
    )


def write_artifacts(preds: DataFrame, cfg: PanelConfig, experiment: str, variant: str, root: str) -> DataFrame:
    """Write a variant's predictions and its resolved configuration (JSON); returns the stored predictions."""
    from ..sources.sinks import read_predictions, write_predictions

    spark = preds.sparkSession
    base = f"{root}/artifacts/{experiment}"
    write_predictions(preds, f"{base}/predictions/variant={variant}")
    payload = dataclasses.asdict(cfg)
    text = json.dumps({"variant": variant, "fingerprint": fingerprint(payload), "config": payload}, default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{base}/config/variant={variant}")
    return read_predictions(spark, f"{base}/predictions/variant={variant}")


def write_run_log(records: DataFrame, root: str) -> None:
    """Put runs into a Parquet run log partitioned by experiment and run. A run written again replaces its rows (dynamic
    partition overwrite). The commits, written last by the same keys, say how many rows each run has: a run without its
    commit, or with other rows than that, was not written to its end and is not read."""
    spark = records.sparkSession
    keys = ("experiment", "run")
    replace = lambda df, path: df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
    replace(records, f"{root}/records")
    stored = spark.read.option("basePath", f"{root}/records").parquet(f"{root}/records")
    written = records.select(*keys).distinct()
    counts = stored.join(written, list(keys), "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    replace(counts.withColumn("committed", F.current_timestamp()), f"{root}/commits")


def read_run_log(spark: SparkSession, root: str, experiment: str | None = None) -> DataFrame:
    """The committed runs (of one experiment)."""
    of = lambda part: spark.read.option("basePath", f"{root}/{part}").parquet(f"{root}/{part}")
    records, commits = of("records"), of("commits")
    if experiment is not None:
        records, commits = (x.where(F.col("experiment") == experiment) for x in (records, commits))
    rows = records.groupBy("experiment", "run").agg(F.count(F.lit(1)).alias("rows"))
    whole = commits.select("experiment", "run", "rows").join(rows, ["experiment", "run", "rows"]).select("experiment", "run")
    return records.join(whole, ["experiment", "run"], "left_semi").select(*records.columns)


def read_artifacts(spark: SparkSession, experiment: str, root: str) -> tuple[DataFrame, DataFrame]:
    """(predictions by variant; variant, fingerprint and configuration as JSON) of an experiment's stored runs."""
    base = f"{root}/artifacts/{experiment}"
    schema = T.StructType([*PREDICTIONS.fields, T.StructField("variant", T.StringType())])
    predictions = spark.read.schema(schema).parquet(f"{base}/predictions")
    fields = "variant string, fingerprint string, config string"
    config = spark.read.text(f"{base}/config").select(F.from_json("value", fields).alias("c")).select("c.*")
    return predictions, config
