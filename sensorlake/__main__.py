"""Command line for the jobs, for ``spark-submit`` or ``python -m sensorlake``.

    python -m sensorlake registry --api PATH --registry PATH
    python -m sensorlake archive  --landing PATH --bronze PATH --checkpoint PATH --schema PATH
    python -m sensorlake live     --format json|kafka --source PATH --bronze PATH --checkpoint PATH
    python -m sensorlake readings --live PATH --archive PATH --readings PATH
    python -m sensorlake devices  --registry PATH --live PATH --devices PATH
    python -m sensorlake gold     --readings PATH --devices PATH --gold PATH
    python -m sensorlake update   --live PATH --archive PATH --readings PATH --registry PATH
                                  --devices PATH --gold PATH --new-live PATH --new-archive PATH
    python -m sensorlake manifest --listings PATH --registry PATH --landed PATH --manifest PATH
                                  --start DAY --end DAY

Common options: ``--config FILE[#env]`` (YAML/JSON settings), ``--run-log PATH``,
``--option key=value`` (bus options, repeatable), ``--continuous`` (live: fixed-interval trigger
instead of drain-and-stop).
"""

from __future__ import annotations

import argparse

from sensorlake import config, jobs
from sensorlake.plans import bronze
from sensorlake.session import build_session


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sensorlake")
    p.add_argument("job", choices=["registry", "archive", "live", "readings", "devices",
                                   "gold", "update", "manifest"])
    for name in ("api", "registry", "landing", "bronze", "checkpoint", "schema", "source",
                 "live", "archive", "readings", "devices", "gold", "config", "run-log", "new-live",
                 "new-archive", "positions", "listings", "landed", "manifest", "start", "end"):
        p.add_argument(f"--{name}")
    p.add_argument("--format", default="json")
    p.add_argument("--option", action="append", default=[])
    p.add_argument("--continuous", action="store_true")
    p.add_argument("--dates", help="gold: comma-separated event dates to recompute (NULL for "
                                   "readings without a time); all dates when omitted")
    return p


def main(argv: list[str] | None = None, spark=None):
    a = parser().parse_args(argv)
    s = config.load_settings(a.config)
    spark = spark or build_session(app=f"sensorlake-{a.job}")
    log = a.run_log
    if a.job == "registry":
        return jobs.registry_job(spark, a.api, a.registry, s, log)
    if a.job == "archive":
        return jobs.archive_job(spark, a.landing, a.bronze, a.checkpoint, a.schema, s, log)
    if a.job == "live":
        opts = dict(o.split("=", 1) for o in a.option)
        return jobs.live_job(spark, a.format, opts, a.bronze, a.checkpoint, a.source, s, log,
                             available_now=not a.continuous)
    if a.job == "readings":
        return jobs.silver_readings_job(spark, a.live, a.archive, a.readings, s, run_log=log)
    if a.job == "devices":
        return jobs.silver_devices_job(spark, a.registry, a.live, a.devices, log, a.positions)
    if a.job == "update":
        new = [bronze.read_table(spark, p) if p else None for p in (a.new_live, a.new_archive)]
        return jobs.incremental_update(spark, a.live, a.archive, a.readings, a.devices, a.gold,
                                       *new, s, log, a.registry, a.positions)
    if a.job == "manifest":
        listings, landed = (spark.read.parquet(p) for p in (a.listings, a.landed))
        return jobs.manifest_job(spark, listings, a.registry, landed, a.start, a.end, a.manifest,
                                 s, log)
    dates = None
    if a.dates:
        import datetime as dt
        dates = spark.createDataFrame(
            [(None if d.upper() == "NULL" else dt.date.fromisoformat(d),)
             for d in dict.fromkeys(a.dates.split(","))], "event_date date")
    return jobs.gold_job(spark, a.readings, a.devices, a.gold, s, log, dates=dates)


if __name__ == "__main__":
    print(main())
