"""Sources and sinks: CSV scans, partitioned Parquet, dataset versions, JSON,
file fingerprints, and the dataset registry."""
