"""Risk analytics as Spark jobs: history features, encoding, tests, models, reports."""
