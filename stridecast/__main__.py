"""Command line: one sub-command per job. Run with ``spark-submit`` or ``python -m stridecast``."""

from __future__ import annotations

import argparse
from contextlib import nullcontext

from stridecast.functions.messages import flatten_message, parse_messages
from stridecast.operators.filters import by_model
from stridecast.operators.serving import box_stats, heatmap, histogram, kpis, risk_zones
from stridecast.plans.ingest import ingest_csv
from stridecast.plans.training import TRAINERS, train_from_table
from stridecast.schema import DATE_PARTS, MONTH_PARTS
from stridecast.session import build_session
from stridecast.sources.files import compact_mobility, stream_table
from stridecast.sources.jdbc import JdbcConfig, connection_works, read_predictions
from stridecast.sources.kafka import MessageConfig, mobility_stream
from stridecast.sources.models import load_newest
from stridecast.sources.store import FileStore, JdbcStore
from stridecast.streaming.progress import ProgressLog
from stridecast.streaming.replay import checked_rows, messages_of, start_refused, start_replay
from stridecast.streaming.runs import finish
from stridecast.streaming.scoring import start_scoring
from stridecast.streaming.windows import WINDOW, start_closed_windows, start_untimed, window_metrics


def _messages(args) -> MessageConfig:
    if args.servers or args.folder:
        return MessageConfig(args.servers, args.folder, max_per_trigger=args.max_per_trigger)
    return MessageConfig.from_env()


def _store(spark, args):
    if not args.jdbc:
        return FileStore(spark, args.store)
    cfg = JdbcConfig.from_env()
    if not connection_works(spark, cfg):
        raise SystemExit("the database does not answer the probe query")
    return JdbcStore(spark, cfg, f"{args.store}/quarantine")


def _ingest(spark, args):
    parts = DATE_PARTS if args.days else MONTH_PARTS
    strict = not args.by_name
    print(ingest_csv(spark, args.input, args.output, strict, args.rejects, max_null=args.max_null, partition_by=parts))


def _compact(spark, args):
    compact_mobility(spark, args.input, args.output, DATE_PARTS if args.days else MONTH_PARTS)


def _train(spark, args):
    print(train_from_table(spark, args.input, args.models, kind=args.kind))


def _finish_both(query, second, interval):
    """Wait for the first query; the second ends with it, or has a bounded run of its own."""
    try:
        finish(query)
    finally:
        if second and interval:
            second.stop()
    if second:
        finish(second)


def _followed(spark, args):
    """Keeps each batch's progress below the folder in ``--progress``."""
    return ProgressLog(spark, args.progress) if args.progress else nullcontext()


def _replay(spark, args):
    rows = checked_rows(stream_table(spark, args.input, args.max_per_trigger))
    refused = None
    with _followed(spark, args) as log:
        if args.rejects:
            refused = start_refused(rows, args.rejects, f"{args.checkpoint}-rejects", args.interval)
        query = start_replay(messages_of(rows), _messages(args), args.checkpoint, args.interval)
        _finish_both(query, refused, args.interval)
        if log:
            log.wait(query)


def _score(spark, args):
    model = load_newest(spark, f"{args.models}/registry", args.kind)
    stream = mobility_stream(spark, _messages(args))
    with _followed(spark, args) as log:
        query = finish(
            start_scoring(
                stream, _store(spark, args), args.checkpoint, model, args.kind, interval=args.interval
            )
        )
        if log:
            log.wait(query)


def _windows(spark, args):
    flat = flatten_message(parse_messages(mobility_stream(spark, _messages(args))))
    found = window_metrics(flat, args.window, watermark=args.delay)
    left_out = None
    if args.rejects:
        left_out = start_untimed(flat, args.rejects, f"{args.checkpoint}-rejects", args.interval)
    with _followed(spark, args) as log:
        query = start_closed_windows(found, args.output, args.checkpoint, args.interval)
        _finish_both(query, left_out, args.interval)
        if log:
            log.wait(query)


def _promote(spark, args):
    print(_store(spark, args).promote())


def _report(spark, args):
    if args.jdbc:
        rows = read_predictions(spark, JdbcConfig.from_env())
    else:
        rows = FileStore(spark, args.store).predictions()
    kpis(rows).show(truncate=False)
    histogram(by_model(rows, args.kind)).orderBy("bin").show(30)
    box_stats(rows).show()
    risk_zones(rows, args.threshold).show()
    heatmap(rows).show()


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(prog="stridecast")
    commands = parser.add_subparsers(required=True)

    def command(name, run, *options):
        sub = commands.add_parser(name)
        sub.set_defaults(run=run)
        for flag, settings in options:
            sub.add_argument(flag, **settings)

    needed = {"required": True}
    kind = ("--kind", {"choices": sorted(TRAINERS), "default": "LinearRegression"})
    store = [("--store", needed), ("--jdbc", {"action": "store_true"})]
    transport = [
        ("--servers", {}),
        ("--folder", {}),
        ("--max-per-trigger", {"type": int}),
        ("--checkpoint", needed),
        ("--interval", {}),
        ("--progress", {}),
    ]
    command(
        "ingest",
        _ingest,
        ("--input", needed),
        ("--output", needed),
        ("--by-name", {"action": "store_true"}),
        ("--days", {"action": "store_true"}),
        ("--rejects", {}),
        ("--max-null", {"type": float, "default": 0.5}),
    )
    command("compact", _compact, ("--input", needed), ("--output", needed), ("--days", {"action": "store_true"}))
    command("train", _train, ("--input", needed), ("--models", needed), kind)
    command("replay", _replay, ("--input", needed), ("--rejects", {}), *transport)
    command("score", _score, ("--models", needed), kind, *store, *transport)
    command(
        "windows",
        _windows,
        ("--output", needed),
        ("--window", {"default": WINDOW}),
        ("--delay", {"default": WINDOW}),
        ("--rejects", {}),
        *transport,
    )
    command("promote", _promote, *store)
    command("report", _report, *store, kind, ("--threshold", {"type": float, "default": 0.0}))
    args = parser.parse_args(argv)
    spark = build_session()
    try:
        args.run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
