"""Reproduce the README's skew measurement.

    python -m tests.skew_probe [sf_dir] [copies] [max_per_row|none]

Builds the shows table over comments where one show holds a third of all
rows (``comments_flat(hot=True)``), optionally replicated ``copies`` times
under new comment ids, with an event log in a fresh scratch folder, then
reports per shuffle stage the largest task's share of the shuffled bytes
and of the run time.
"""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import sys
import tempfile
import time

from pyspark.sql import functions as F

from reelscope.operators import shows as S
from reelscope.plans import fixtures as fx
from reelscope.session import get_session


def stage_skew(log_dir: str, min_bytes: int = 10_000_000) -> list[str]:
    import zstandard
    app = max(glob.glob(log_dir + "/*"), key=os.path.getmtime)
    files = sorted(glob.glob(app + "/events_*")) if os.path.isdir(app) else [app]
    tasks = collections.defaultdict(list)
    for fn in files:
        raw = open(fn, "rb").read()
        if fn.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode().splitlines():
            e = json.loads(line)
            if e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
                m = e["Task Metrics"]
                r = m.get("Shuffle Read Metrics", {})
                tasks[e["Stage ID"]].append((r.get("Remote Bytes Read", 0) + r.get("Local Bytes Read", 0),
                                             m.get("Executor Run Time", 0)))
    out = []
    for sid, xs in sorted(tasks.items()):
        tb, tt = sum(b for b, _ in xs), sum(t for _, t in xs)
        if tb >= min_bytes:
            mb, mt = max(b for b, _ in xs), max(t for _, t in xs)
            out.append(f"stage {sid}: {len(xs)} tasks, {tb / 1e6:.0f} MB shuffled; largest task "
                       f"{100 * mb / tb:.1f}% of bytes, {mt / 1000:.1f}s of {tt / 1000:.1f}s run time")
    return out


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    copies = int(argv[1]) if len(argv) > 1 else 1
    mpr = None if len(argv) > 2 and argv[2] == "none" else int(argv[2]) if len(argv) > 2 else 50_000
    log_dir = tempfile.mkdtemp(prefix="reelscope-skew-")
    spark = get_session("local[8]", shuffle_partitions=32,
                        extra={"spark.driver.memory": "16g", "spark.eventLog.enabled": "true",
                               "spark.eventLog.dir": log_dir})
    c = fx.comments_flat(spark, sf_dir, hot=True)
    if copies > 1:
        c = (c.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"))
             .withColumn("comment_id", F.concat_ws("~", "comment_id", F.col("copy").cast("string")))
             .drop("copy"))
    t0 = time.perf_counter()
    shows = S.shows_flat(S.assemble_shows(fx.catalog_clean(spark, sf_dir), c, max_per_row=mpr))
    r = shows.agg(F.max("n_comments")).first()
    print(f"max_per_row={mpr} copies={copies}: {time.perf_counter() - t0:.1f}s, "
          f"largest show {r[0]} comments")
    spark.stop()
    for line in stage_skew(log_dir):
        print(line)


if __name__ == "__main__":
    main(sys.argv[1:])
