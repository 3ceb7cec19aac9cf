"""Sources and sinks: CSV at the edges, Parquet between stages, JSON metrics."""
