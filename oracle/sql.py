"""Oracle SQL by query name."""

from __future__ import annotations

from oracle import cleaning, quality, relational, storage
from oracle.ctes import with_ctes

LAYERS = (
    "raw_customers", "raw_products", "raw_stores", "raw_transactions", "stg_customers", "stg_products", "stg_stores",
    "stg_transactions", "intmd_customers", "intmd_products", "intmd_stores", "intmd_transactions",
)


def oracle() -> dict[str, str]:
    """Each query's SQL with the CTEs it needs in front."""
    sql = {name: f"SELECT * FROM {name}" for name in LAYERS}
    for family in (cleaning, relational, quality, storage):
        sql |= family.ORACLE
    return {name: with_ctes(text) for name, text in sql.items()}
