"""Query plans: the analytical catalog, dashboard datasets, report metrics, mart."""
