"""The command line from CSV to promoted predictions, in one process after another's files."""

import pytest

import stridecast.__main__ as cli
from stridecast.sources.store import FileStore
from tests.test_files import mobility


@pytest.fixture
def shared_session(spark, monkeypatch):
    """Let commands use the test session and leave it running."""

    class Kept:
        def __getattr__(self, name):
            return (lambda: None) if name == "stop" else getattr(spark, name)

    monkeypatch.setattr(cli, "build_session", Kept)


def test_jobs_in_sequence(spark, folder, shared_session, capsys):
    mobility(spark, 40).write.csv(f"{folder}/csv", header=True)
    wire = ["--folder", f"{folder}/messages"]
    store = ["--store", f"{folder}/store"]
    cli.main(["ingest", "--input", f"{folder}/csv", "--output", f"{folder}/table"])
    cli.main(["train", "--input", f"{folder}/table", "--models", f"{folder}/models"])
    cli.main(["replay", "--input", f"{folder}/table", "--checkpoint", f"{folder}/c1", *wire])
    cli.main(["score", "--models", f"{folder}/models", "--checkpoint", f"{folder}/c2", *wire, *store])
    cli.main(["windows", "--output", f"{folder}/windows", "--checkpoint", f"{folder}/c3", *wire])
    cli.main(["promote", *store])
    cli.main(["report", *store])
    printed = capsys.readouterr().out
    assert "n_rows=80" in printed and "total_predictions" in printed
    assert spark.read.parquet(f"{folder}/windows").columns[:4] == ["window_start", "window_end", "country", "n"]
    predictions = FileStore(spark, f"{folder}/store").predictions()
    assert predictions.count() == 80 and predictions.where("prediction IS NULL").count() == 0
