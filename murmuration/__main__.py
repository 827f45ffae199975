"""Command line for cleaning, the three analyses, and their streaming forms.

    python -m murmuration prep     RAW_DIR CLEAN_DIR
    python -m murmuration activity CLEAN_DIR OUT_DIR
    python -m murmuration suggest  CLEAN_DIR OUT_DIR --config settings.properties
    python -m murmuration outliers CLEAN_DIR OUT_DIR --lexicon words.json
    python -m murmuration publish  CLEAN_DIR BROKERS
    python -m murmuration stream-threads|stream-activity|stream-outliers|stream-rejects|stream-gate BROKERS WORK_DIR
    python -m murmuration stream-suggest BROKERS WORK_DIR --clean CLEAN_DIR [--selected PEOPLE.parquet]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmuration.operators import affinity
from murmuration.params import Params
from murmuration.plans import analyses, prep
from murmuration.runtime import drop_intermediates
from murmuration.sources.files import INPUTS, lexicon_table, read_clean, read_properties
from murmuration.streaming import jobs

BATCH = ("prep", "activity", "suggest", "outliers", "publish")
STREAMS = ("stream-threads", "stream-activity", "stream-suggest", "stream-outliers", "stream-rejects", "stream-gate")


def run_batch(spark: SparkSession, args: argparse.Namespace, p: Params) -> None:
    if args.job == "prep":
        prep.prepare(spark, args.source, args.target, args.format)
        return
    clean = {table: read_clean(spark, args.source, table, args.format) for table in INPUTS}
    if args.job == "activity":
        analyses.activity_messages(clean, p).write.parquet(f"{args.target}/activity")
    elif args.job == "suggest":
        affinity.suggest_wide(analyses.friend_suggestions(clean, p, _selected(spark, args), args.ids), p).write.parquet(f"{args.target}/suggestions")
    elif args.job == "publish":
        prep.publish_clean(clean, {"kafka.bootstrap.servers": args.target})
    else:
        on_update, daily = analyses.unusual_people(clean, lexicon_table(spark, args.lexicon), p)
        on_update.write.parquet(f"{args.target}/outliers_on_update")
        daily.write.parquet(f"{args.target}/outliers_daily")


def _selected(spark: SparkSession, args: argparse.Namespace) -> DataFrame | None:
    """The people to suggest for as a table, if one is named; else those of the settings."""
    return spark.read.parquet(args.selected).select(F.col("selected_id").cast(args.ids).alias("selected_id")) if args.selected else None


def run_stream(spark: SparkSession, args: argparse.Namespace, p: Params) -> None:
    source = jobs.Topics({"kafka.bootstrap.servers": args.source})
    run = jobs.Run(args.target, params=p, idle_s=args.idle)
    if args.job == "stream-threads":
        query = jobs.start_threads(spark, source, run, args.max_age)
    elif args.job == "stream-activity":
        query = jobs.start_activity(spark, source, run, max_age_ms=args.max_age)
    elif args.job == "stream-outliers":
        query = jobs.start_outliers(spark, source, run, lexicon_table(spark, args.lexicon))
    elif args.job == "stream-rejects":
        query = jobs.start_rejects(spark, source, run)
    elif args.job == "stream-gate":
        query = jobs.start_gate(spark, source, run)
    else:
        clean = {t: read_clean(spark, args.clean, t, args.format) for t in INPUTS if not INPUTS[t].is_stream}
        selected = _selected(spark, args)
        query = jobs.start_suggestions(
            spark, source, run, analyses.static_scores(clean, p, selected, args.ids), analyses.friendships(clean, args.ids),
            id_type=args.ids, selected=selected)
    query.awaitTermination()


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="murmuration")
    parser.add_argument("job", choices=[*BATCH, *STREAMS])
    parser.add_argument("source")
    parser.add_argument("target")
    parser.add_argument("--config", help="properties file with selected people, weights and delays")
    parser.add_argument("--lexicon", help="JSON file with the word list")
    parser.add_argument("--clean", help="folder of cleaned tables, for static scores")
    parser.add_argument("--selected", help="Parquet table (selected_id) of the people to suggest for")
    parser.add_argument("--ids", default="long", choices=["long", "string"], help="type of people's ids")
    parser.add_argument("--max-age", type=int, help="milliseconds after which a waiting reply is an orphan")
    parser.add_argument("--idle", type=float, help="seconds after which a silent topic does not hold the others")
    parser.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    args = parser.parse_args(argv)
    if args.job.endswith("outliers") and not args.lexicon:
        parser.error("outliers need --lexicon")
    if args.job == "stream-suggest" and not args.clean:
        parser.error("stream-suggest needs --clean")

    spark = SparkSession.builder.appName(f"murmuration-{args.job}").getOrCreate()
    p = Params.from_properties(read_properties(args.config)) if args.config else Params()
    if args.job in BATCH:
        run_batch(spark, args, p)
        drop_intermediates(spark)
    else:
        run_stream(spark, args, p)


if __name__ == "__main__":
    main()
