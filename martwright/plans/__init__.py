"""The commerce plans: bronze, silver, gold, quality and KPIs."""
