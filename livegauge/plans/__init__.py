"""The jobs: ingest, snapshot difference, baseline, report."""
