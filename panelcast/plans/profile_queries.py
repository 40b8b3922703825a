"""Registered profiling queries (AG6-AG11, JN12)."""

from __future__ import annotations

from ..operators import profile
from ..sources import adapters
from .backtest import prepped_for
from .common import NATION, SUPPLIER, rounded
from .oracle_sql import with_panel
from .registry import register


@register(
    "dataset_span",
    with_panel("nation", "SELECT MIN(starttime) AS first_ts, MAX(starttime) AS last_ts, CAST(COUNT(*) AS BIGINT) AS n_rows FROM trips"),
)
def q_span(spark, sf_dir):
    return profile.dataset_span(adapters.nation_trips(spark, sf_dir))


@register(
    "covariate_coverage",
    with_panel(
        "nation",
        "SELECT CAST(COUNT(*) AS BIGINT) AS n_days, MIN(date) AS first_day, MAX(date) AS last_day, "
        "CAST(COUNT(temp) AS BIGINT) AS n_temp, CAST(COUNT(prcp) AS BIGINT) AS n_prcp FROM weather",
    ),
)
def q_coverage(spark, sf_dir):
    return profile.covariate_coverage(adapters.weather_shards(spark, sf_dir), NATION)


@register(
    "split_counts",
    with_panel(
        "supplier",
        "SELECT series, CAST(COUNT_IF(splits = 'TRAIN') AS BIGINT) AS n_train, "
        "CAST(COUNT_IF(splits = 'VALIDATE') AS BIGINT) AS n_validate, CAST(COUNT_IF(splits = 'TEST') AS BIGINT) AS n_test "
        "FROM prepped GROUP BY series",
        SUPPLIER,
    ),
)
def q_split_counts(spark, sf_dir):
    return profile.split_counts(prepped_for(spark, sf_dir, "supplier", SUPPLIER), SUPPLIER)


@register(
    "series_ranges",
    with_panel(
        "supplier",
        "SELECT series, MIN(date) AS first_day, MAX(date) AS last_day, CAST(COUNT(*) AS BIGINT) AS n_days FROM prepped GROUP BY series",
        SUPPLIER,
    ),
)
def q_series_ranges(spark, sf_dir):
    return profile.series_ranges(prepped_for(spark, sf_dir, "supplier", SUPPLIER), SUPPLIER)


@register(
    "split_boundaries",
    with_panel(
        "nation",
        f"SELECT MAX(date) AS last_day, CAST(MAX(date) - {NATION.test_length} AS DATE) AS test_cut, "
        f"CAST(MAX(date) - {NATION.test_length + NATION.validate_length} AS DATE) AS validate_cut, "
        f"CAST(MAX(date) - {NATION.test_length - 1} AS DATE) AS test_start, "
        f"CAST(MAX(date) - {NATION.test_length + NATION.validate_length - 1} AS DATE) AS validate_start FROM prepped",
    ),
)
def q_split_boundaries(spark, sf_dir):
    return profile.split_boundaries(prepped_for(spark, sf_dir, "nation", NATION), NATION)


@register(
    "topk_mean_test",
    with_panel(
        "supplier",
        "SELECT series, ROUND(AVG(CAST(target AS DOUBLE)), 6) AS mean_test FROM prepped WHERE splits = 'TEST' "
        "GROUP BY series ORDER BY AVG(CAST(target AS DOUBLE)) DESC, series ASC LIMIT 5",
        SUPPLIER,
    ),
)
def q_topk(spark, sf_dir):
    return rounded(profile.topk_mean_test(prepped_for(spark, sf_dir, "supplier", SUPPLIER), SUPPLIER, 5))


@register(
    "metadata_coverage",
    with_panel(
        "supplier",
        "SELECT s.series, (m.name IS NOT NULL) AS has_metadata FROM (SELECT DISTINCT series FROM prepped) s "
        "LEFT JOIN (SELECT DISTINCT name FROM meta WHERE capacity IS NOT NULL) m ON s.series = m.name",
        SUPPLIER,
    ),
)
def q_meta_coverage(spark, sf_dir):
    prepped = prepped_for(spark, sf_dir, "supplier", SUPPLIER)
    return profile.metadata_coverage(prepped, adapters.customer_meta(spark, sf_dir), SUPPLIER)
