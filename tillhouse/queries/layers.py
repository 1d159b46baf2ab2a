"""Whole layer tables."""

from __future__ import annotations

from tillhouse.plans.inputs import Warehouse
from tillhouse.queries.registry import QUERIES

for _name in (
    "stg_customers", "stg_products", "stg_stores", "stg_transactions",
    "intmd_customers", "intmd_products", "intmd_stores", "intmd_transactions",
):
    QUERIES[_name] = lambda spark, sf_dir, _n=_name: getattr(Warehouse(spark, sf_dir, whole=_n.endswith("_transactions")), _n)()
for _name in ("customers", "products", "stores", "transactions"):
    QUERIES[f"raw_{_name}"] = lambda spark, sf_dir, _n=_name: Warehouse(spark, sf_dir).raw(_n)
