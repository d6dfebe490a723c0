"""Sources: the message envelope, Kafka options, the Redis data source, envelope files, listings."""
