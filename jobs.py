"""Jobs for spark-submit: ``spark-submit --py-files tasteloom.zip jobs.py train --reviews ..``"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tasteloom.plans import training
from tasteloom.sources import kafka, recstore, registry
from tasteloom.sources.replay import read_feed, replay_messages
from tasteloom.sources.reviews import read_reviews, write_csv
from tasteloom.streaming.models import CHECK_EVERY, ModelCache
from tasteloom.streaming.recommender import TOP_N, TRIGGER_SECONDS, start_recommender


def preprocess(spark: SparkSession, a: argparse.Namespace) -> None:
    """Latest review per pair, active users, indices: a CSV folder."""
    write_csv(training.preprocess(read_reviews(spark, a.reviews, a.multiline), a.min_user).ratings, a.out)


def replay(spark: SparkSession, a: argparse.Namespace) -> None:
    """The replayed part of the reviews as messages: to Kafka, or to a folder of text files."""
    messages = replay_messages(read_reviews(spark, a.reviews, a.multiline))
    if a.servers:
        kafka.write_topic(messages, a.servers, a.topic)
    else:
        messages.write.mode("append").text(a.feed)


def train(spark: SparkSession, a: argparse.Namespace) -> None:
    """Tune, fit, evaluate, save and register a model."""
    reviews = read_reviews(spark, a.reviews, a.multiline)
    version = training.train_and_register(
        reviews, a.models, a.runs, a.name, parallelism=a.parallelism, ranks=a.ranks, reg_params=a.reg_params
    )
    print(f"registered {a.name} version {version}")


def recommend(spark: SparkSession, a: argparse.Namespace) -> None:
    """Score the users of rating events until stopped, or once over what is there."""
    limits = {"maxOffsetsPerTrigger": str(a.max_offsets)} if a.max_offsets else {}
    if a.allow_data_loss:
        limits["failOnDataLoss"] = "false"
    feed = kafka.read_topic(spark, a.servers, a.topic, **limits) if a.servers else read_feed(spark, a.feed)
    models = ModelCache(spark, a.runs, a.name, check_every=a.check_every)
    trigger = {"availableNow": True} if a.once else {"processingTime": f"{a.trigger} seconds"}
    start_recommender(feed, models, a.store, a.checkpoint, a.top_n, a.run_seq, trigger, a.once_per).awaitTermination()


def compact(spark: SparkSession, a: argparse.Namespace) -> None:
    """Fold stored batches into one base table."""
    recstore.compact(spark, a.store)
    if a.drop:
        recstore.drop_compacted(spark, a.store)


def snapshot(spark: SparkSession, a: argparse.Namespace) -> None:
    """The newest recommendations as a table for lookups by user."""
    recstore.write_snapshot(recstore.current(spark, a.store), a.out, a.buckets)


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    def command(run, *paths: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(run.__name__, description=run.__doc__)
        sub.set_defaults(run=run)
        for path in paths:
            sub.add_argument(f"--{path}", required=True)
        if "reviews" in paths:
            sub.add_argument("--multiline", action="store_true")
        return sub

    def endpoint(sub: argparse.ArgumentParser) -> None:
        where = sub.add_mutually_exclusive_group(required=True)
        where.add_argument("--servers")
        where.add_argument("--feed")
        sub.add_argument("--topic", default=kafka.TOPIC)

    command(preprocess, "reviews", "out").add_argument("--min-user", type=int, default=3)
    endpoint(command(replay, "reviews"))
    sub = command(train, "reviews", "models", "runs")
    sub.add_argument("--name", default=registry.MODEL_NAME)
    sub.add_argument("--parallelism", type=int, default=1)
    sub.add_argument("--ranks", type=int, nargs="+", default=training.RANKS)
    sub.add_argument("--reg-params", type=float, nargs="+", default=training.REG_PARAMS)
    sub = command(recommend, "runs", "store", "checkpoint")
    endpoint(sub)
    sub.add_argument("--name", default=registry.MODEL_NAME)
    sub.add_argument("--top-n", type=int, default=TOP_N)
    sub.add_argument("--run-seq", type=int, default=0)
    sub.add_argument("--once-per", type=int, help="seconds within which a user seen again is not scored again")
    sub.add_argument("--check-every", type=float, default=CHECK_EVERY)
    sub.add_argument("--once", action="store_true")
    sub.add_argument("--trigger", type=int, default=TRIGGER_SECONDS, help="seconds between micro-batches")
    sub.add_argument("--max-offsets", type=int, help="most Kafka records per micro-batch (default: no limit)")
    sub.add_argument("--allow-data-loss", action="store_true", help="skip expired Kafka offsets instead of failing")
    command(compact, "store").add_argument("--drop", action="store_true", help="delete batches the base holds")
    command(snapshot, "store", "out").add_argument("--buckets", type=int, default=64)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    a = arguments(argv)
    a.run(SparkSession.builder.appName(f"tasteloom-{a.command}").getOrCreate(), a)


if __name__ == "__main__":
    main()
