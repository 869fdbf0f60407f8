"""Sources: explicit schemas, the driver-table adapter, the layer folder layout,
CSV/Parquet readers and writers, and fault-isolated ingestion."""
