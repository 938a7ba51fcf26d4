"""Connector options; no broker or database is contacted."""

import pytest

from stridecast.sources import jdbc
from stridecast.sources.kafka import MessageConfig, reader_options, writer_options

KAFKA = MessageConfig(servers="broker:9092", max_per_trigger=5000)
DB = jdbc.JdbcConfig(url="jdbc:x:y", driver="d.D", user="u", password="p", extra={"ssl": "false"})


def test_stream_starts_at_the_newest_offset_and_tolerates_loss():
    assert reader_options(KAFKA) == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "mobility-data",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "5000",
    }


def test_delivery_settings():
    assert writer_options(KAFKA) == {
        "kafka.bootstrap.servers": "broker:9092",
        "topic": "mobility-data",
        "kafka.acks": "all",
        "kafka.retries": "5",
        "kafka.linger.ms": "10",
        "kafka.retry.backoff.ms": "500",
    }


@pytest.mark.parametrize("places", [{}, {"servers": "a", "folder": "b"}])
def test_messages_live_in_exactly_one_place(places):
    with pytest.raises(ValueError):
        MessageConfig(**places)


def test_password_is_not_shown():
    assert "password" not in repr(DB)


def test_table_read_is_split_within_the_connection_limit():
    options = jdbc.table_options(DB, "predictions", ("epoch_id", 0, 1000, 64))
    assert options["numPartitions"] == "16" and options["partitionColumn"] == "epoch_id"
    assert options["lowerBound"] == "0" and options["upperBound"] == "1000"
    assert options["ssl"] == "false" and options["fetchsize"] == "10000"


def test_staging_write_is_batched():
    options = jdbc.staging_options(DB)
    assert options["dbtable"] == "predictions_staging" and options["batchsize"] == "10000"


def test_absent_credentials_are_left_out():
    assert "user" not in jdbc.base_options(jdbc.JdbcConfig(url="jdbc:x:y", driver="d.D"))


def test_settings_from_the_environment(monkeypatch):
    monkeypatch.setenv("STRIDECAST_JDBC_URL", "jdbc:a:b")
    monkeypatch.setenv("STRIDECAST_JDBC_DRIVER", "x.Y")
    monkeypatch.setenv("STRIDECAST_KAFKA_SERVERS", "h:1")
    monkeypatch.delenv("STRIDECAST_MESSAGE_FOLDER", raising=False)
    assert jdbc.JdbcConfig.from_env().url == "jdbc:a:b"
    assert MessageConfig.from_env().servers == "h:1"
