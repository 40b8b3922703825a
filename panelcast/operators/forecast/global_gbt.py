"""FC6/FC7/FC8: one boosted model across all series, trained for its quantile levels (direct multi-step).

A training row is (series, target day d, step h): the origin's features at day d-h (the last 7 values, the mean of the last
``context_window`` and the covariates that are unknown at forecast time), what is known of day d (weather, calendar, holiday), the
static attributes, h, and the label y_d. A value after the origin is never seen.

Fit, all by Spark aggregation:

* ``day_rows``: one window pass over the panel gives each day its own features; a rank sketch over TRAIN sets at most ``BINS``
  bins a feature, and each day's features are binned once, one byte each (0: missing). The bytes of the H possible origins of a
  day stand beside it in one row; rows by step exist only inside a task.
* a round fits one tree for each of the five levels, all levels in one job. The pinball loss' gradient is level - 1 or level, so
  a node's histogram is two counts by feature and bin (rows, rows below the prediction): integers, which sum alike in any
  order. The task that sums a node's histograms hands on its best split only.
* a leaf's value is the level's quantile of its rows' residuals, from rank summaries of at most ``SUMMARY`` weighted points a
  task and leaf, merged by Spark (exact up to that many rows; beyond, within 1 / SUMMARY in rank).
* VALIDATE (the last days before TEST, which is never read) gives one shift a level and step: the exact quantile of what is left,
  so a level covers its share there.

The forecast is the nested ``predicted_<target>`` struct, flattened by level (PR16). Edges, trees and shifts are stored below one
path, the model reference that ``GlobalModel.load`` takes. Of a forecast day that the panel lacks, calendar and holiday follow
from the date and the weather from any other series' row of that day.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ...config import QUANTILES, TEST, VALIDATE, PanelConfig
from ..frames import flatten_nested
from ..quantiles import grouped_quantiles
from .future import known_of_day

N_LAGS = 7
#: Bins of a feature (beside 0 for missing), points of a rank summary, and the byte of an origin before a series' first day.
BINS, SUMMARY, NO_ORIGIN = 63, 4096, 255
MIN_ROWS = 20  # rows of a child
FAN_IN = 16  # tasks whose summaries are merged first


# -- features -----------------------------------------------------------------
def origin_features(cfg: PanelConfig) -> list[str]:
    return [*[f"y_lag{i}" for i in range(N_LAGS)], "y_mean", *[f"u_{c}" for c in cfg.roles.unavailable]]


def known_features(cfg: PanelConfig) -> list[str]:
    return [*[f"k_{c}" for c in cfg.roles.available], "k_holiday", *[f"a_{c}" for c in cfg.roles.attribute]]


def feature_names(cfg: PanelConfig) -> list[str]:
    """In the order of the binned matrix."""
    return ["h", *origin_features(cfg), *known_features(cfg)]


def day_rows(prepped: DataFrame, cfg: PanelConfig, context_window: int = 28) -> DataFrame:
    """One row per non-TEST day: series, date, splits, label and the features of the day as target and as origin."""
    s, t, y = cfg.series_column, cfg.time_column, cfg.target_column
    w = Window.partitionBy(s).orderBy(t)
    yv = F.col(y).cast("double")
    return prepped.where(F.col("splits") != F.lit(TEST)).select(
        F.col(s).alias("series"), F.col(t).alias("date"), "splits", yv.alias("label"),
        *[F.lag(yv, i).over(w).alias(f"y_lag{i}") for i in range(N_LAGS)],
        F.avg(yv).over(w.rowsBetween(-(context_window - 1), 0)).alias("y_mean"),
        *[F.col(c).cast("double").alias(f"u_{c}") for c in cfg.roles.unavailable],
        *known_of_day(cfg),
    )


def bin_edges(days: DataFrame, cfg: PanelConfig, bins: int = BINS) -> dict[str, list[float]]:
    """Upper limits of each feature's bins (ranks of a sketch over TRAIN days; the last bin has none)."""
    names = feature_names(cfg)[1:]
    grid = [(i + 1) / bins for i in range(bins - 1)]
    row = days.where(F.col("splits") != F.lit(VALIDATE)).agg(*[F.percentile_approx(c, grid, 100 * bins).alias(c) for c in names]).first()
    return {c: sorted(set(row[c] or [])) for c in names}


def to_bins(values: np.ndarray, edges: list[float]) -> np.ndarray:
    """0 where missing, else 1 + the number of limits below the value."""
    return np.where(np.isnan(values), 0, 1 + np.searchsorted(np.asarray(edges, float), values, side="left")).astype(np.uint8)


def _bin(edges: dict[str, list[float]], groups: dict[str, list[str]], keep: pa.Schema):
    schema = pa.schema([*keep, *[(g, pa.binary()) for g in groups]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(f.name).cast(f.type) for f in keep]
            for names in groups.values():
                m = np.stack([to_bins(batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False), edges[c]) for c in names], axis=1)
                columns.append(pa.array([r.tobytes() for r in m], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def binned(days: DataFrame, cfg: PanelConfig, edges: dict[str, list[float]]) -> DataFrame:
    """(series, date, splits, label, known, origins): one byte a feature; ``origins`` has the bytes of days d-1 .. d-H."""
    keep = pa.schema([("series", pa.string()), ("date", pa.date32()), ("splits", pa.string()), ("label", pa.float64())])
    groups = {"known": known_features(cfg), "origin": origin_features(cfg)}
    own = days.withColumn("series", F.col("series").cast("string")).mapInArrow(
        _bin(edges, groups, keep), "series string, date date, splits string, label double, known binary, origin binary"
    )
    w = Window.partitionBy("series").orderBy("date")
    none = F.lit(bytes([NO_ORIGIN]) * len(groups["origin"]))
    before = [F.coalesce(F.lag("origin", h).over(w), none) for h in range(1, cfg.horizon + 1)]
    return own.select("series", "date", "splits", "label", "known", F.concat(*before).alias("origins"))


def expand(known: list[bytes], origins: list[bytes], horizon: int) -> tuple[np.ndarray, np.ndarray]:
    """(feature matrix of uint8, index of the day) of a batch's (day, step) rows that have an origin."""
    if not known:
        return np.zeros((0, 0), np.uint8), np.zeros(0, np.int64)
    k = np.frombuffer(b"".join(known), np.uint8).reshape(len(known), -1)
    o = np.frombuffer(b"".join(origins), np.uint8).reshape(len(known), horizon, -1)
    day, step = np.nonzero(o[:, :, 0] != NO_ORIGIN)
    return np.concatenate([(step + 1).astype(np.uint8)[:, None], o[day, step], k[day]], axis=1), day


# -- trees --------------------------------------------------------------------
class Forest:
    """Per level a start value and trees: feature (-1: none, all rows go left) and bin limit by node, values by leaf."""

    def __init__(self, start: list[float], depth: int):
        self.start, self.depth = start, depth
        self.trees: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = []  # by round, by level

    def nodes(self, x: np.ndarray, feature: np.ndarray, limit: np.ndarray, depth: int) -> np.ndarray:
        """The place among its depth's nodes that each row reaches."""
        at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        for d in range(depth):
            node = (1 << d) - 1 + at
            f = feature[node]
            at = 2 * at + ((f >= 0) & (x[rows, np.maximum(f, 0)] > limit[node]))
        return at

    def predict(self, x: np.ndarray) -> np.ndarray:
        """(rows, levels)"""
        out = np.tile(np.asarray(self.start, float), (len(x), 1))
        for tree in self.trees:
            for q, (feature, limit, value) in enumerate(tree):
                out[:, q] += value[self.nodes(x, feature, limit, self.depth)]
        return out

    def dump(self) -> str:
        return json.dumps({"start": self.start, "depth": self.depth, "trees": [[[a.tolist() for a in t] for t in r] for r in self.trees]})

    @classmethod
    def read(cls, text: str) -> Forest:
        d = json.loads(text)
        out = cls(d["start"], d["depth"])
        out.trees = [[(np.array(f, np.int64), np.array(m, np.int64), np.array(v, float)) for f, m, v in r] for r in d["trees"]]
        return out


def _rows(batch: pa.RecordBatch, horizon: int) -> tuple[np.ndarray, np.ndarray]:
    x, day = expand(batch.column("known").to_pylist(), batch.column("origins").to_pylist(), horizon)
    return x, batch.column("label").to_numpy(zero_copy_only=False)[day]


HISTOGRAM = "level int, node int, counts binary"


def _histograms(forest: Forest, grown: list, depth: int, horizon: int, width: int):
    """A task's counts by (level, node): rows and rows below the prediction, by feature and bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x, y = _rows(batch, horizon)
            if not len(x):
                continue
            if total is None:
                total = np.zeros((len(grown), 1 << depth, x.shape[1], width, 2), np.int64)
            f = forest.predict(x)
            cells = x.astype(np.int64) * 2
            for q, (feature, limit) in enumerate(grown):
                base = forest.nodes(x, feature, limit, depth) * (2 * width) + (y < f[:, q])
                for j in range(x.shape[1]):
                    total[q, :, j] += np.bincount(base + cells[:, j], minlength=(1 << depth) * width * 2).reshape(1 << depth, width, 2)
        if total is not None:
            keys = [(q, n) for q in range(total.shape[0]) for n in range(total.shape[1]) if total[q, n].any()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([q for q, _ in keys], pa.int32()), pa.array([n for _, n in keys], pa.int32()),
                 pa.array([total[k].tobytes() for k in keys], pa.binary())],
                names=["level", "node", "counts"],
            )

    return run


def best_split(counts: np.ndarray, level: float, min_rows: int) -> tuple[int, int]:
    """(feature, limit) that most lowers the squared error of the gradients over counts (feature, bin, [above, below]); ties go to
    the least feature and limit; (-1, 0) where no split gains."""
    n, below = counts.sum(2).cumsum(1), counts[:, :, 1].cumsum(1)
    total, total_below = n[:, -1:], below[:, -1:]
    g_left, g_all = level * n - below, level * total - total_below
    right = total - n
    ok = (n >= min_rows) & (right >= min_rows)
    gain = np.where(ok, g_left**2 / np.maximum(n, 1) + (g_all - g_left) ** 2 / np.maximum(right, 1) - g_all**2 / np.maximum(total, 1), 0.0)
    at = int(np.argmax(np.round(gain, 9)))
    feature, limit = divmod(at, counts.shape[1])
    return (feature, limit) if gain[feature, limit] > 1e-9 else (-1, 0)


def _split(n_features: int, width: int, min_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, level, node = None, 0, 0
        for batch in batches:
            for level, node, counts in zip(*(batch.column(c).to_pylist() for c in ("level", "node", "counts")), strict=True):
                one = np.frombuffer(counts, np.int64)
                total = one.copy() if total is None else total + one
        feature, limit = best_split(total.reshape(n_features, width, 2), QUANTILES[level], min_rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], pa.int32()) for v in (level, node, feature, limit)], names=["level", "node", "feature", "bound"]
        )

    return run


def summary(values: np.ndarray, weights: np.ndarray, size: int = SUMMARY) -> tuple[np.ndarray, np.ndarray]:
    """Weighted points in order, at most ``size``: neighbours are merged at even ranks, each run kept as its middle value."""
    order = np.argsort(values, kind="stable")
    values, weights = values[order], weights[order]
    if len(values) <= size:
        return values, weights
    upto = np.cumsum(weights)
    ends = np.unique(np.searchsorted(upto, np.linspace(0, upto[-1], size + 1)[1:]))
    ends = np.minimum(ends, len(values) - 1)
    middle = np.searchsorted(upto, (np.append(0, upto[ends[:-1]]) + upto[ends]) / 2)
    return values[np.minimum(middle, len(values) - 1)], np.diff(np.append(0, upto[ends]))


def weighted_quantile(values: np.ndarray, weights: np.ndarray, level: float) -> float:
    """The least value that a share ``level`` of the weight doesn't exceed."""
    upto = np.cumsum(weights)
    return float(values[min(np.searchsorted(upto, level * upto[-1] - 1e-9), len(values) - 1)])


POINTS = "level int, leaf int, team int, v array<double>, w array<long>"
_POINTS = pa.schema([("level", pa.int32()), ("leaf", pa.int32()), ("team", pa.int32()), ("v", pa.list_(pa.float64())), ("w", pa.list_(pa.int64()))])


def _residuals(forest: Forest, grown: list, horizon: int, depth: int, size: int):
    """A task's rank summaries of the residuals by (level, leaf)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            x, y = _rows(batch, horizon)
            if not len(x):
                continue
            f = forest.predict(x)
            for q, (feature, limit) in enumerate(grown):
                r, leaf = y - f[:, q], forest.nodes(x, feature, limit, depth)
                order = np.argsort(leaf, kind="stable")
                names, first = np.unique(leaf[order], return_index=True)
                for name, at in zip(names.tolist(), np.split(order, first[1:]), strict=True):
                    v, w = held.get((q, name), (np.zeros(0), np.zeros(0, np.int64)))
                    held[q, name] = summary(np.concatenate([v, r[at]]), np.concatenate([w, np.ones(len(at), np.int64)]), size)
        team = TaskContext.get().partitionId() // FAN_IN
        columns = [[q for q, _ in held], [n for _, n in held], [team] * len(held), [v.tolist() for v, _ in held.values()], [w.tolist() for _, w in held.values()]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _POINTS, strict=True)], schema=_POINTS)

    return run


def _merge(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, w, level, leaf = np.zeros(0), np.zeros(0, np.int64), 0, 0
        for batch in batches:
            for level, leaf, _, more_v, more_w in zip(*(batch.column(f.name).to_pylist() for f in _POINTS), strict=True):
                v, w = summary(np.concatenate([v, more_v]), np.concatenate([w, np.asarray(more_w, np.int64)]), size)
        columns = [[level], [leaf], [0], [v.tolist()], [w.tolist()]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _POINTS, strict=True)], schema=_POINTS)

    return run


def _leaf_quantiles(rows: DataFrame, forest: Forest, grown: list, horizon: int, depth: int, size: int, many: bool) -> dict[tuple[int, int], float]:
    points = rows.mapInArrow(_residuals(forest, grown, horizon, depth, size), POINTS)
    if many:  # tasks: a tree of merges
        points = points.groupBy("level", "leaf", "team").applyInArrow(_merge(size), POINTS)
    merged = points.groupBy("level", "leaf").applyInArrow(_merge(size), POINTS)
    found = merged.select("level", "leaf", "v", "w").toArrow().to_pylist()  # levels x leaves rows
    return {(r["level"], r["leaf"]): weighted_quantile(np.array(r["v"]), np.array(r["w"]), QUANTILES[r["level"]]) for r in found}


def boost(rows: DataFrame, n_features: int, horizon: int, max_iter: int, max_depth: int, learning_rate: float,
          min_rows: int = MIN_ROWS, size: int = SUMMARY, width: int = BINS + 2) -> Forest:
    """``max_iter`` rounds over binned day rows; a level of depth of all five trees is one job."""
    stump = [(np.full(1, -1), np.zeros(1, np.int64))] * len(QUANTILES)
    many = rows.select(F.spark_partition_id().alias("part")).distinct().count() > FAN_IN
    start = _leaf_quantiles(rows, Forest([0.0] * len(QUANTILES), 0), stump, horizon, 0, size, many)
    forest = Forest([start.get((q, 0), 0.0) for q in range(len(QUANTILES))], max_depth)
    for _ in range(max_iter):
        grown = [(np.full((1 << max_depth) - 1, -1), np.zeros((1 << max_depth) - 1, np.int64)) for _ in QUANTILES]
        for depth in range(max_depth):
            counts = rows.mapInArrow(_histograms(forest, grown, depth, horizon, width), HISTOGRAM)
            splits = counts.groupBy("level", "node").applyInArrow(_split(n_features, width, min_rows), "level int, node int, feature int, bound int")
            for q, node, feature, limit in splits.collect():  # levels x nodes rows
                grown[q][0][(1 << depth) - 1 + node], grown[q][1][(1 << depth) - 1 + node] = feature, limit
        leaf = _leaf_quantiles(rows, forest, grown, horizon, max_depth, size, many)
        values = [np.array([learning_rate * leaf.get((q, n), 0.0) for n in range(1 << max_depth)]) for q in range(len(QUANTILES))]
        forest.trees.append([(f, m, v) for (f, m), v in zip(grown, values, strict=True)])
    return forest


# -- model --------------------------------------------------------------------
def _predict(forest: Forest, horizon: int, ids: bool):
    """(day, step) rows -> predictions of all levels; with ``ids`` the series and day, else the label."""
    keys = [("series", pa.string()), ("date", pa.date32())] if ids else [("label", pa.float64())]
    schema = pa.schema([*keys, ("h", pa.int32()), ("preds", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, day = expand(batch.column("known").to_pylist(), batch.column("origins").to_pylist(), horizon)
            if not len(x):
                continue
            f = forest.predict(x)
            columns = [batch.column(k).cast(t).take(pa.array(day)) for k, t in keys]
            preds = pa.ListArray.from_arrays(pa.array(np.arange(len(f) + 1) * f.shape[1], pa.int32()), pa.array(f.ravel()))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(x[:, 0], pa.int32()), preds], schema=schema)

    return run


class GlobalModel:
    """The bins' edges, the trees and the shifts by step, stored below one path: the reference that ``load`` takes in any
    later session."""

    def __init__(self, edges: dict[str, list[float]], forest: Forest, shifts: DataFrame, path: str):
        self.edges, self.forest, self.shifts, self.path = edges, forest, shifts, path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> GlobalModel:
        parts = {r["part"]: r["body"] for r in spark.read.parquet(f"{path}/model").collect()}  # two rows
        return cls(json.loads(parts["edges"]), Forest.read(parts["forest"]), spark.read.parquet(f"{path}/shifts"), path)


def fit_global(prepped: DataFrame, cfg: PanelConfig, model_path: str, max_iter: int = 12, max_depth: int = 3,
               learning_rate: float = 0.3, context_window: int = 28) -> GlobalModel:
    """Fit on TRAIN targets, shifts by level and step from VALIDATE; stored below ``model_path`` and loaded from it."""
    from ...sources.tables import materialize

    spark = prepped.sparkSession
    days = day_rows(prepped, cfg, context_window)
    edges = bin_edges(days, cfg)
    rows = materialize(binned(days, cfg, edges).where("label IS NOT NULL"), "gbt-binned")
    train, valid = rows.where(F.col("splits") != F.lit(VALIDATE)), rows.where(F.col("splits") == F.lit(VALIDATE))
    forest = boost(train, len(feature_names(cfg)), cfg.horizon, max_iter, max_depth, learning_rate)
    left = valid.mapInArrow(_predict(forest, cfg.horizon, ids=False), "label double, h int, preds array<double>")
    left = left.select("h", F.posexplode("preds").alias("level", "p"), "label").select("h", "level", (F.col("label") - F.col("p")).alias("r"))
    # per (step, level) all five quantiles; the level's own is taken
    shifts = grouped_quantiles(materialize(left, "gbt-residuals"), ["h", "level"], "r", QUANTILES)
    by_step = shifts.select("h", "level", F.col("quantiles")[F.col("level")].alias("v")).groupBy("h").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("level", "v"))), lambda x: x["v"]).alias("shift")
    )
    by_step.write.mode("overwrite").parquet(f"{model_path}/shifts")
    body = [("edges", json.dumps(edges)), ("forest", forest.dump())]
    spark.createDataFrame(body, "part string, body string").coalesce(1).write.mode("overwrite").parquet(f"{model_path}/model")
    return GlobalModel.load(spark, model_path)


def forecast_rows(prepped: DataFrame, cfg: PanelConfig, context_window: int = 28) -> DataFrame:
    """Origin = each series' last non-TEST day; a row per future day with the features of both."""
    from .future import future_days

    last = Window.partitionBy("series").orderBy(F.desc("date"))
    ends = day_rows(prepped, cfg, context_window).withColumn("_rn", F.row_number().over(last)).where(F.col("_rn") == 1)
    ends = ends.select("series", "date", *origin_features(cfg))
    return future_days(ends.withColumnRenamed("date", "last_date"), prepped, cfg)


def forecast_global(model: GlobalModel, prepped: DataFrame, cfg: PanelConfig,
                    model_name: str = "global_gbt", context_window: int = 28) -> DataFrame:
    s, t, y = cfg.series_column, cfg.time_column, cfg.target_column
    rows = forecast_rows(prepped, cfg, context_window)
    keep = pa.schema([("series", pa.string()), ("date", pa.date32()), ("h", pa.int32())])
    groups = {"known": known_features(cfg), "origin": origin_features(cfg)}
    bins = rows.withColumn("series", F.col("series").cast("string")).mapInArrow(
        _bin(model.edges, groups, keep), "series string, date date, h int, known binary, origin binary"
    )
    # the row's only origin stands at its step
    none = F.lit(bytes([NO_ORIGIN]) * len(groups["origin"]))
    origins = F.concat(*[F.when(F.col("h") == h, F.col("origin")).otherwise(none) for h in range(1, cfg.horizon + 1)])
    pred = bins.select("series", "date", "known", origins.alias("origins")).mapInArrow(
        _predict(model.forest, cfg.horizon, ids=True), "series string, date date, h int, preds array<double>"
    )
    q = pred.join(F.broadcast(model.shifts), "h", "left")  # one row per step: bounded by the horizon
    nothing = F.array(*[F.lit(0.0) for _ in QUANTILES])
    levels = F.array_sort(F.zip_with("preds", F.coalesce("shift", nothing), lambda p, c: p + c))
    nested = q.select(
        F.col("series").alias(s), F.col("date").alias(t),
        F.struct(
            levels[QUANTILES.index(0.5)].alias("value"), F.array(*[F.lit(v) for v in QUANTILES]).alias("quantile_values"),
            levels.alias("quantile_predictions"),
        ).alias(f"predicted_{y}"),
    )
    return flatten_nested(nested, y, s, t, model_name)
