"""Where rows go: files, Kafka, several sinks at once, the run log."""

from staywise.sinks.batches import fan_out_once
from staywise.sinks.fanout import fan_out
from staywise.sinks.file_tables import files, files_stream
from staywise.sinks.kafka_topics import kafka, kafka_batches

__all__ = ["fan_out", "fan_out_once", "files", "files_stream", "kafka", "kafka_batches"]
