"""All models built from one raw-orders DataFrame (the dependency graph of
the model layer: raw -> stg_* -> fct / dim_*, dim_date standalone).

Building every model from the same DataFrame object keeps expression ids
shared, so when several models meet in one plan (the test suite, a star
join) identical sub-plans and shuffles are reused instead of recomputed.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tillflow.config import DATE_SPINE_DAYS, DATE_SPINE_START
from tillflow.plans import marts, staging


@dataclass
class ModelParams:
    as_of: dt.date | None = None            # reporting day; None = today
    spine_start: dt.date = DATE_SPINE_START
    spine_days: int = DATE_SPINE_DAYS
    country_rule: str = "max"
    spine_from_data: bool = False            # calendar over the years in raw


@dataclass
class Models:
    spark: SparkSession
    raw: DataFrame
    params: ModelParams = field(default_factory=ModelParams)

    def __post_init__(self):
        p = self.params
        self.stg_orders = staging.stg_orders(self.raw)
        self.stg_customers = staging.stg_customers(self.raw, p.country_rule)
        self.stg_products = staging.stg_products(self.raw)
        self.fct_orders = marts.fct_orders(self.stg_orders)
        self.dim_customers = marts.dim_customers(self.stg_customers, p.as_of)
        self.dim_products = marts.dim_products(self.stg_products)
        if p.spine_from_data:
            self.dim_date = marts.dim_date_covering(self.raw)
        else:
            self.dim_date = marts.dim_date(self.spark, p.spine_start, p.spine_days)

    def as_dict(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in MODEL_NAMES}


MODEL_NAMES = ("stg_orders", "stg_customers", "stg_products", "fct_orders",
               "dim_customers", "dim_products", "dim_date")
VIEW_MODELS = ("stg_orders", "stg_customers", "stg_products")
TABLE_MODELS = ("fct_orders", "dim_customers", "dim_products", "dim_date")
