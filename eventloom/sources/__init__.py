"""Sources and sinks: topics (Kafka or file-backed), text, CSV, incremental loads."""
