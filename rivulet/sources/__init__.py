"""Readers and writers: driver parquet tables, record views, file/Kafka streams, sinks."""
