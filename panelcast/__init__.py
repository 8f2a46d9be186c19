"""panelcast: forecasting on panel data (one row per entity and period) with PySpark DataFrames."""
