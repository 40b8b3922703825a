"""Shared settings of the registered queries (adapters, configs, rounding)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import PanelConfig
from ..sources.adapters import ADAPTER_CONFIGS

# Every series of the table: the panel queries run over whole tables.
ALL_SERIES = None

NATION = ADAPTER_CONFIGS["nation"]
SUPPLIER = ADAPTER_CONFIGS["supplier"].replace(top_n=ALL_SERIES)
USER = ADAPTER_CONFIGS["user"].replace(top_n=ALL_SERIES)
# Top-k report only: the 10 busiest suppliers (ties at the cut by name).
SUPPLIER_TOP10 = ADAPTER_CONFIGS["supplier"].replace(top_n=10)

CONFIGS: dict[str, PanelConfig] = {"nation": NATION, "supplier": SUPPLIER, "user": USER}

DIGITS = 6


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column (the oracle rounds the same way)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
