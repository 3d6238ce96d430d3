"""Commerce analytics on Spark: raw CSV to bronze, silver, gold, quality report and KPIs."""
