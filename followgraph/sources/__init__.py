"""Sources and sinks: TSV edge/topic loaders, Parquet writers, driver tables."""
