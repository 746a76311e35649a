"""Command line: ``python -m medallion <load|refresh|build|stream> ...``.

Runs on whatever master ``spark-submit`` / ``SPARK_*`` configure; nothing
here sets a master, so the same command runs locally and on a cluster.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from medallion import jobs
from medallion.contracts import SILVER_SPECS
from medallion.session import apply_conf, sizing

# Share of its input that a job shuffles: loads and compactions exchange per-file counts only.
JOB_SHUFFLE = {"load": 0.0, "compact": 0.0}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="medallion")
    p.add_argument("--input-bytes", type=int, help="size the session for this much input")
    p.add_argument("--cores", type=int, help="total executor cores (with --input-bytes)")
    sub = p.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("load", help="batch load landing files into Bronze")
    s.add_argument("--landing", required=True)
    s.add_argument("--bronze", required=True)
    s.add_argument("--load-id", help="load every file under this id; without it, files not loaded before")

    s = sub.add_parser("compact", help="rewrite old Bronze loads into one load")
    s.add_argument("--bronze", required=True)
    s.add_argument("--into", required=True, help="load id of the compacted load")
    s.add_argument("--keep-recent", type=int, default=60)

    s = sub.add_parser("compact-silver", help="rewrite old Silver batch folders into one per table")
    s.add_argument("--silver", required=True)
    s.add_argument("--keep-recent", type=int, default=60)

    s = sub.add_parser("expire", help="drop old versions and the folders that only they name")
    s.add_argument("--bronze")
    s.add_argument("--silver", help="Silver root folder: all its tables")
    s.add_argument("--gold")
    s.add_argument("--keep-versions", type=int, default=100)

    s = sub.add_parser("refresh", help="full refresh of Silver from Bronze")
    s.add_argument("--bronze", required=True)
    s.add_argument("--silver", help="Silver root folder (Parquet)")
    s.add_argument("--database", help="catalog database for bucketed Silver tables")
    s.add_argument("--buckets", type=int, default=0)
    s.add_argument("--auto", action="store_true", help="apply the new loads only, or rebuild, whichever their size calls for")

    s = sub.add_parser("build", help="write Gold models and run the data tests")
    s.add_argument("--silver", required=True)
    s.add_argument("--gold", required=True)
    s.add_argument("--calendar-start", default="2024-01-01")
    s.add_argument("--calendar-end", default="2027-12-31")
    s.add_argument("--threads", type=int, default=4)
    s.add_argument("--fail-on-test", action="store_true", help="a build with a failing test isn't published")
    s.add_argument("--env", help="publish the models as catalog views <env>_gold.<model>")
    s.add_argument("--schema", help="publish into this schema instead (with --env)")

    s = sub.add_parser("stream", help="landing -> Bronze -> Silver upkeep stream")
    s.add_argument("--landing", required=True)
    s.add_argument("--bronze", required=True)
    s.add_argument("--silver", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--available-now", action="store_true")
    s.add_argument("--horizon-days", type=int, default=None)
    s.add_argument("--archive-dir")
    s.add_argument("--notifications", help="folder of finalize notifications: read the files they name, list nothing")
    s.add_argument("--quarantine", action="store_true", help="set rows with uncastable values aside")

    a = p.parse_args(argv)
    spark = apply_conf(SparkSession.builder.appName(f"medallion-{a.cmd}").getOrCreate())
    if a.input_bytes and a.cores:
        for k, v in sizing(a.input_bytes, a.cores, JOB_SHUFFLE.get(a.cmd, 0.3)).items():
            spark.conf.set(k, v)

    if a.cmd == "load":
        if a.load_id:
            jobs.load(spark, a.landing, a.bronze, a.load_id)
        else:
            jobs.load_new(spark, a.landing, a.bronze)
        print(f"loaded {a.landing} as {a.load_id or 'new files'}")
    elif a.cmd == "compact":
        old = jobs.compact_bronze(spark, a.bronze, a.into, a.keep_recent)
        print(f"compacted {len(old)} loads into {a.into}")
    elif a.cmd == "compact-silver":
        for name in SILVER_SPECS:
            print(f"{name}: {len(jobs.compact_silver(spark, a.silver, name, a.keep_recent))} folders")
    elif a.cmd == "expire":
        silver = [f"{a.silver.rstrip('/')}/{spec.table}" for spec in SILVER_SPECS.values()] if a.silver else []
        for root, folders in jobs.expire(spark, [r for r in (a.bronze, *silver, a.gold) if r], a.keep_versions).items():
            print(f"{root}: {len(folders)} folders")
    elif a.cmd == "refresh":
        if a.buckets and a.database:
            out = jobs.refresh_silver_bucketed(spark, a.bronze, a.database, a.buckets)
        elif a.silver and a.auto:
            done = jobs.refresh_auto(spark, a.bronze, a.silver)
            out = {n: f"{p['mode']} ({p['new_bytes']} of {p['all_bytes']} bytes new)" for n, p in done.items()}
        elif a.silver:
            out = jobs.refresh_silver(spark, a.bronze, a.silver)
        else:
            p.error("refresh needs --silver, or --database with --buckets")
        print("\n".join(f"{k}: {v}" for k, v in out.items()))
    elif a.cmd == "build":
        report = jobs.build(spark, a.silver, a.gold, (a.calendar_start, a.calendar_end),
                            threads=a.threads, env=a.env, custom_schema=a.schema, require_pass=a.fail_on_test)
        failing = report.where("failures > 0").orderBy("relation", "column_name", "test")
        rows = failing.collect()  # one row per failing declared test (at most 117)
        for r in rows:
            print(f"FAIL {r.relation}.{r.column_name} {r.test}: {r.failures}")
        print(f"{len(rows)} failing tests")
        if rows and a.fail_on_test:
            return 1
    elif a.cmd == "stream":
        from medallion.streaming import start_ingest_stream, start_notified_stream

        if a.notifications:
            q = start_notified_stream(
                spark, a.notifications, a.landing, a.bronze, a.checkpoint, a.silver,
                trigger={"availableNow": True} if a.available_now else None,
                horizon_days=a.horizon_days, quarantine=a.quarantine,
            )
            q.awaitTermination()
            return 0
        q = start_ingest_stream(
            spark, a.landing, a.bronze, a.silver, a.checkpoint,
            trigger={"availableNow": True} if a.available_now else None,
            horizon_days=a.horizon_days,
            clean_source="archive" if a.archive_dir else None,
            archive_dir=a.archive_dir,
            quarantine=a.quarantine,
        )
        q.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
