"""Command line for spark-submit: publish, refresh, append, train, score, check-inputs,
index-names, search, report, links, prompts, merge.

    spark-submit --py-files trackmart.zip trackmart/jobs.py publish --raw ... --root ...
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart import schemas as S
from trackmart.operators import artists, profiles, states
from trackmart.operators import search as names
from trackmart.operators.features import input_domain_check
from trackmart.operators.model import score_tracks
from trackmart.plans import insight, publishing, training
from trackmart.plans import refresh as refreshing
from trackmart.session import build_session, staged
from trackmart.sinks import keyed, tables
from trackmart.sources.fingerprint import (
    last_recorded,
    listing_fingerprint,
    record,
    table_fingerprint,
)
from trackmart.sources.snapshots import current_version, read_table, snapshot_path
from trackmart.sources.tracks import MALFORMED, read_tracks_csv


def publish(spark: SparkSession, args: argparse.Namespace, now: datetime) -> None:
    listing, manifest = f"{args.root}/input-listing", f"{args.root}/input-manifest"
    files = listing_fingerprint(spark, args.raw) if args.skip_unchanged else None
    if files and files == last_recorded(spark, listing):
        print("input files unchanged, nothing published")
        return
    tokens = S.PANDAS_NULL_TOKENS if args.pandas_nulls else ()
    text = read_tracks_csv(
        spark, args.raw, null_tokens=tokens, multiline=args.multiline, keep_malformed=True
    )
    with staged(text, "raw-tracks") as parsed:  # parse once, for several columnar passes
        malformed = parsed.agg(F.count(MALFORMED).alias("malformed_rows"))
        tables.write_report(malformed, f"{args.root}/reports/malformed_rows")
        raw = parsed.drop(MALFORMED)
        if args.skip_unchanged:
            current = tuple(table_fingerprint(raw).first())
            if current == last_recorded(spark, manifest):
                print("input unchanged, nothing published")
                return
        done = publishing.clean_and_publish(raw, args.root, _version(now), now, args.min_rows)
    if args.skip_unchanged:  # a failed run is tried again
        record(spark, manifest, current, now)
        record(spark, listing, files, now)
    print(f"published {done.version}; advisory checks failed: {done.failed_raw_checks}")


def refresh(spark: SparkSession, args: argparse.Namespace, now: datetime) -> None:
    """States of the years whose tracks changed, then the marts they make."""
    changed = refreshing.refresh_states(_tracks(spark, args.root), f"{args.root}/mart_states")
    if changed:
        kept = refreshing.read_states(spark, f"{args.root}/mart_states")
        for name, build in STATE_MARTS.items():
            tables.publish(build(kept), f"{args.root}/{name}", _version(now), now)
    print(f"refreshed years: {changed}")


STATE_MARTS = {
    "music_trends": states.music_trends,
    "genre_stats": states.genre_stats,
    "mood_map": states.mood_map,
    "artist_stats": states.artist_stats,
}


def append(spark: SparkSession, args: argparse.Namespace, now: datetime) -> None:
    """Tracks whose id the bucketed table lacks; a batch is appended once."""
    rows = spark.read.parquet(args.tracks)
    schema = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes)
    keyed.create(spark, f"{args.root}/{args.table}", schema, args.key, args.buckets)
    done = keyed.append_absent(rows, f"{args.root}/{args.table}", args.batch)
    print(f"batch {args.batch}: {'appended' if done else 'was appended before'}")


def index_names(spark: SparkSession, args: argparse.Namespace, now: datetime) -> None:
    """A snapshot of the name postings of the current artist statistics."""
    path = snapshot_path(f"{args.root}/name_postings", _version(now))
    names.write_postings(read_table(spark, f"{args.root}/artist_stats"), path)
    tables.announce(spark, f"{args.root}/name_postings", _version(now), now)


def train(spark: SparkSession, args: argparse.Namespace, now: datetime) -> None:
    training.train_and_save(
        _tracks(spark, args.root),
        f"{args.root}/models/{args.kind}",
        now,
        args.kind,
        weigh_all=args.weigh_all,
        max_label_rows=args.max_label_rows,
    )


def score(spark: SparkSession, args: argparse.Namespace, now: datetime) -> None:
    fitted = training.load_model(f"{args.root}/models/{args.kind}", args.kind)
    _write(score_tracks(fitted, spark.read.parquet(args.requests)), args)


def check_inputs(spark: SparkSession, args: argparse.Namespace, now: datetime) -> None:
    _write(input_domain_check(spark.read.parquet(args.requests)), args)


def search(spark: SparkSession, args: argparse.Namespace, now: datetime) -> None:
    stats = read_table(spark, f"{args.root}/artist_stats")
    if args.indexed:
        _write(names.indexed_search(stats, read_table(spark, f"{args.root}/name_postings"), args.term), args)
    else:
        _write(artists.artist_search(stats, args.term), args)


def report(spark: SparkSession, args: argparse.Namespace, now: datetime) -> None:
    _write(artists.artist_report(_tracks(spark, args.root), _profiles(spark, args.root)), args)


def links(spark: SparkSession, args: argparse.Namespace, now: datetime) -> None:
    known = artists.primary_genre(read_table(spark, f"{args.root}/artist_stats"))
    _write(profiles.similar_artist_links(_profiles(spark, args.root), known), args)


def prompts(spark: SparkSession, args: argparse.Namespace, now: datetime) -> None:
    _write(insight.pending_prompts(_tracks(spark, args.root), _profiles(spark, args.root)), args)


def merge(spark: SparkSession, args: argparse.Namespace, now: datetime) -> None:
    stats = read_table(spark, f"{args.root}/artist_stats")
    replies = insight.read_replies(stats, spark.read.parquet(args.replies))
    with staged(replies, "parsed-replies") as parsed:
        if args.batch:
            path = f"{args.root}/{BUCKETED_PROFILES}"
            if keyed.state(spark, path) is None:
                keyed.create(spark, path, S.ARTIST_PROFILES.toDDL(), "artist_name")
                keyed.append_absent(_profiles(spark, args.root), path, "stored")
            keyed.upsert(profiles.accepted(parsed), path, args.batch, profiles.profile_upsert)
            rejected = profiles.quarantine(parsed)
            rejected.write.mode("overwrite").parquet(f"{args.root}/rejected_replies/{args.batch}")
            return
        merged = insight.merge_replies(_profiles(spark, args.root), parsed)
        version = _version(now)
        tables.publish(merged.profiles, f"{args.root}/artist_profiles", version, now)
        merged.rejected.write.mode("overwrite").parquet(f"{args.root}/rejected_replies/{version}")


BUCKETED_PROFILES = "artist_profiles_by_name"


def _write(frame: DataFrame, args: argparse.Namespace) -> None:
    frame.write.mode("overwrite").parquet(args.out)


def _tracks(spark: SparkSession, root: str):
    return read_table(spark, f"{root}/tracks")


def _profiles(spark: SparkSession, root: str):
    """Stored profiles, bucketed ones if there are any; an empty table before the first merge."""
    if keyed.state(spark, f"{root}/{BUCKETED_PROFILES}") is not None:
        return keyed.read(spark, f"{root}/{BUCKETED_PROFILES}")
    path = f"{root}/artist_profiles"
    if current_version(spark, path) is None:
        return spark.createDataFrame([], S.ARTIST_PROFILES)
    return read_table(spark, path)


def _version(now: datetime) -> str:
    return now.strftime("%Y%m%dT%H%M%S%f")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="trackmart")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, run) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        sub.add_argument("--root", required=True, help="folder of the published tables")
        sub.add_argument("--shuffle-partitions", type=int, help="about one per 200 MB shuffled")
        sub.set_defaults(run=run)
        return sub

    sub = command("publish", publish)
    sub.add_argument("--raw", required=True, help="CSV file or folder")
    sub.add_argument("--min-rows", type=int, default=S.MIN_ROWS)
    sub.add_argument("--multiline", action="store_true", help="fields may hold line breaks; one task a file")
    sub.add_argument("--pandas-nulls", action="store_true", help="read NA, None, ... as null")
    sub.add_argument("--skip-unchanged", action="store_true")
    command("refresh", refresh)
    sub = command("append", append)
    sub.add_argument("--tracks", required=True, help="Parquet folder of the rows to append")
    sub.add_argument("--batch", required=True, help="name of the batch; repeated ones do nothing")
    sub.add_argument("--table", default="track_details_by_id")
    sub.add_argument("--key", default="track_id")
    sub.add_argument("--buckets", type=int, default=keyed.BUCKETS, help="of a table that is new")
    command("index-names", index_names)
    sub = command("train", train)
    sub.add_argument("--kind", choices=[training.FULL, training.COMPACT], default=training.FULL)
    sub.add_argument("--weigh-all", action="store_true", help="class weights from all rows")
    sub.add_argument("--max-label-rows", type=int, help="fit on so many rows at most")
    sub = command("score", score)
    sub.add_argument("--kind", choices=[training.FULL, training.COMPACT], default=training.FULL)
    sub.add_argument("--requests", required=True)
    sub.add_argument("--out", required=True)
    sub = command("check-inputs", check_inputs)
    sub.add_argument("--requests", required=True)
    sub.add_argument("--out", required=True)
    sub = command("search", search)
    sub.add_argument("--term", required=True)
    sub.add_argument("--indexed", action="store_true", help="through the postings of index-names")
    sub.add_argument("--out", required=True)
    for name, run in (("report", report), ("links", links), ("prompts", prompts)):
        command(name, run).add_argument("--out", required=True)
    sub = command("merge", merge)
    sub.add_argument("--replies", required=True)
    sub.add_argument("--batch", help="merge into the bucketed table, rewriting touched buckets only")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    now = datetime.now(timezone.utc)
    conf = {"spark.sql.shuffle.partitions": str(args.shuffle_partitions)} if args.shuffle_partitions else {}
    args.run(build_session(f"trackmart-{args.command}", **conf), args, now)


if __name__ == "__main__":
    main()
