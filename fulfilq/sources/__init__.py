"""Sources and sinks: raw CSV landing zone, curated Parquet, fixtures from the test tables."""
