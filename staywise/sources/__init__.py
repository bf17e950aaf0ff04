"""Where rows come from: files, Kafka, rows in memory."""

from staywise.sources.file_tables import files, files_stream
from staywise.sources.kafka_topics import kafka
from staywise.sources.memory import rows

__all__ = ["files", "files_stream", "kafka", "rows"]
