"""Model-level plans: the three models chained, materialized and run incrementally."""
