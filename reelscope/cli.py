"""spark-submit entry points for the jobs (L1–L4).

    spark-submit reelscope/cli.py catalog  RAW_CSV CLEAN_DIR [--quarantine] [--normalize-first]
    spark-submit reelscope/cli.py comments CLEAN_DIR SUBMISSIONS_DIR --flag True \\
        --discussions SUBS_PATH COMMENTS_PATH [--channels "CHANNEL_A CHANNEL_B"]
    spark-submit reelscope/cli.py shows    CLEAN_DIR SUBMISSIONS_DIR TABLE TABLE_DIR RUN_ID
    spark-submit reelscope/cli.py all      RAW_CSV WORK_DIR TABLE RUN_ID [--flag …]

Cluster settings (executors, shuffle partitions, ``spark.checkpoint.dir``)
come from spark-submit; ``--input-bytes/--cores`` apply ``scale_conf``.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reelscope.plans.jobs import (DEFAULT_CHANNELS, RunConfig, comments_mode, run_all,
                                  run_catalog, run_comments, run_shows)
from reelscope.session import get_session, scale_conf


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="reelscope")
    p.add_argument("--input-bytes", type=int, default=None)
    p.add_argument("--cores", type=int, default=None)
    sub = p.add_subparsers(dest="job", required=True)

    c = sub.add_parser("catalog")
    c.add_argument("raw_csv")
    c.add_argument("clean_dir")
    c.add_argument("--quarantine", action="store_true")
    c.add_argument("--normalize-first", action="store_true")
    c.add_argument("--bucketed-table", default=None)

    m = sub.add_parser("comments")
    m.add_argument("clean_dir")
    m.add_argument("submissions_dir")
    m.add_argument("--flag", default=None, help='"True" → collected, else generated')
    m.add_argument("--mode", default=None, choices=["collected", "generated", "both"])
    m.add_argument("--discussions", nargs=2, default=None)
    m.add_argument("--channels", default=DEFAULT_CHANNELS)
    m.add_argument("--format", default="json")

    s = sub.add_parser("shows")
    s.add_argument("clean_dir")
    s.add_argument("submissions_dir")
    s.add_argument("table")
    s.add_argument("table_dir")
    s.add_argument("run_id")
    how = s.add_mutually_exclusive_group()
    how.add_argument("--append", action="store_true", help="reference behaviour: rerun duplicates")
    how.add_argument("--upsert", action="store_true", help="store new and changed shows; publish in one step")

    a = sub.add_parser("all")
    a.add_argument("raw_csv")
    a.add_argument("work_dir")
    a.add_argument("table")
    a.add_argument("run_id")
    a.add_argument("--flag", default=None)
    a.add_argument("--discussions", nargs=2, default=None)
    a.add_argument("--channels", default=DEFAULT_CHANNELS)
    return p


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    extra = scale_conf(args.input_bytes, args.cores) if args.input_bytes and args.cores else None
    spark = get_session(app=f"reelscope-{args.job}", extra=extra)
    if args.job == "catalog":
        run_catalog(spark, args.raw_csv, args.clean_dir,
                    on_malformed="quarantine" if args.quarantine else "drop",
                    normalize_first=args.normalize_first, bucketed_table=args.bucketed_table)
    elif args.job == "comments":
        run_comments(spark, args.mode or comments_mode(args.flag), args.clean_dir,
                     args.submissions_dir, discussions=tuple(args.discussions or ()) or None,
                     channels=args.channels, fmt=args.format)
    elif args.job == "shows":
        run_shows(spark, args.clean_dir, args.submissions_dir, args.table, args.table_dir,
                  args.run_id, mode="append" if args.append else "upsert" if args.upsert else "replace")
    else:
        w = args.work_dir.rstrip("/")
        run_all(spark, RunConfig(
            csv=args.raw_csv, catalog_path=f"{w}/catalog", submissions_path=f"{w}/submissions",
            shows_table=args.table, shows_path=f"{w}/shows", run_id=args.run_id,
            comments_mode=comments_mode(args.flag),
            discussions=tuple(args.discussions) if args.discussions else None,
            channels=args.channels))


if __name__ == "__main__":
    main()
