"""tillhouse: retail analytics on Spark, from raw till extracts to marts and live KPIs."""
