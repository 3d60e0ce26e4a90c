"""Live-audience analytics on Spark: observations, snapshots, baselines, reports."""
