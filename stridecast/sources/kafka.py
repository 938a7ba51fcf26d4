"""Messages over Kafka, or over text files holding one message per line."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Topic name and delivery settings the consumers of the topic rely on.
DEFAULT_TOPIC = "mobility-data"
DELIVERY = {
    "kafka.acks": "all",
    "kafka.retries": "5",
    "kafka.linger.ms": "10",
    "kafka.retry.backoff.ms": "500",
}
#: Message files are compressed; a compressed file is read by one task, so the rows of a file are few.
FILES = {"compression": "snappy", "maxRecordsPerFile": "500000"}


@dataclass(frozen=True)
class MessageConfig:
    """Either ``servers`` (Kafka) or ``folder`` (text files) says where messages live."""

    servers: str | None = None
    folder: str | None = None
    topic: str = DEFAULT_TOPIC
    starting_offsets: str = "latest"
    fail_on_data_loss: bool = False
    max_per_trigger: int | None = None
    min_partitions: int | None = None
    #: Of message files. Gzip, at its quickest, makes them a third smaller than snappy and takes longer to write.
    compression: str = FILES["compression"]

    def __post_init__(self):
        if bool(self.servers) == bool(self.folder):
            raise ValueError("give exactly one of servers and folder")

    @classmethod
    def from_env(cls) -> "MessageConfig":
        return cls(
            servers=os.environ.get("STRIDECAST_KAFKA_SERVERS"),
            folder=os.environ.get("STRIDECAST_MESSAGE_FOLDER"),
            topic=os.environ.get("STRIDECAST_TOPIC", DEFAULT_TOPIC),
        )


def reader_options(cfg: MessageConfig) -> dict[str, str]:
    """Kafka source options. Starting offsets only matter before the first checkpoint."""
    options = {
        "kafka.bootstrap.servers": cfg.servers,
        "subscribe": cfg.topic,
        "startingOffsets": cfg.starting_offsets,
        "failOnDataLoss": str(cfg.fail_on_data_loss).lower(),
    }
    if cfg.max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(cfg.max_per_trigger)
    if cfg.min_partitions:
        options["minPartitions"] = str(cfg.min_partitions)
    return options


def writer_options(cfg: MessageConfig) -> dict[str, str]:
    return {"kafka.bootstrap.servers": cfg.servers, "topic": cfg.topic, **DELIVERY}


def file_options(cfg: MessageConfig) -> dict[str, str]:
    return FILES | {"compression": cfg.compression, "zlib.compress.level": "BEST_SPEED"}


def mobility_stream(spark: SparkSession, cfg: MessageConfig) -> DataFrame:
    """Unbounded frame with column ``value``. For files the trigger limit counts files."""
    if cfg.servers:
        return spark.readStream.format("kafka").options(**reader_options(cfg)).load()
    reader = spark.readStream
    if cfg.max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", cfg.max_per_trigger)
    return reader.text(cfg.folder)


def publish(messages: DataFrame, cfg: MessageConfig) -> None:
    """Send the ``value`` column; every task writes its own rows."""
    values = messages.select("value")
    if cfg.servers:
        values.write.format("kafka").options(**writer_options(cfg)).save()
    else:
        values.write.mode("append").options(**file_options(cfg)).text(cfg.folder)
