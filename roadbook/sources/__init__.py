"""Sources and sinks: yearly CSV shards, ZIP archives, JSON observation pages, Parquet."""
