"""Sources: the driver's parquet tables mapped to the reference's topics,
the topic-log reader (parquet log or Kafka), and delimited-line ingest."""
