"""Shapes the driver's test tables into the nine commerce datasets."""
