"""python -m weftline: run a job file, check it, or hide and show its credentials."""

from __future__ import annotations

import argparse
import base64
import json
import sys

from weftline.plans import config, rules
from weftline.plans.job import SHADED, JobError, run_job, unshade


def shaded(value, names: tuple[str, ...] = SHADED):
    """A job with the values of credentials hidden; the one built-in way is base64."""
    if isinstance(value, dict):
        return {k: base64.b64encode(v.encode()).decode() if k in names and isinstance(v, str) else shaded(v, names) for k, v in value.items()}
    return [shaded(v, names) for v in value] if isinstance(value, list) else value


def shown(value, names: tuple[str, ...] = SHADED):
    if isinstance(value, dict):
        return {k: v if k in names and isinstance(v, str) else shown(v, names) for k, v in unshade(value, "base64", names).items()}
    return [shown(v, names) for v in value] if isinstance(value, list) else value


def faults(job: dict) -> list[str]:
    """What is wrong with a job's options, without running it."""
    out = []
    for kind in ("source", "sink"):
        for plugin, options in config.steps(job.get(kind)):
            try:
                rules.RULES.check(kind, plugin, options)
            except rules.OptionError as e:
                out.append(str(e))
    if not config.steps(job.get("source")) or not config.steps(job.get("sink")):
        out.append("a job needs a source and a sink")
    return out


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="weftline", description=__doc__)
    p.add_argument("-c", "--config", required=True, help="the job file: relaxed JSON, JSON, or .sql")
    p.add_argument("-i", "--variable", action="append", default=[], metavar="NAME=VALUE")
    p.add_argument("-m", "--master", default=None, help="Spark's master, where the session does not name one")
    p.add_argument("-n", "--name", default=None, help="the job's name")
    p.add_argument("-r", "--restore", default=None, help="the savepoint that a streaming job goes on from")
    what = p.add_mutually_exclusive_group()
    what.add_argument("--check", action="store_true", help="check the options and end")
    what.add_argument("--encrypt", action="store_true", help="print the job with its credentials hidden")
    what.add_argument("--decrypt", action="store_true", help="print the job with its credentials in clear")
    given = p.parse_args(args)
    job = config.load(given.config, dict(v.partition("=")[::2] for v in given.variable))
    if given.encrypt or given.decrypt:
        print(json.dumps((shaded if given.encrypt else shown)(job), indent=2, ensure_ascii=False))
        return 0
    if given.check:
        found = faults(job)
        print("\n".join(found) or "no fault found")
        return int(bool(found))
    from pyspark.sql import SparkSession

    builder = SparkSession.builder.appName(given.name or "weftline")
    spark = (builder.master(given.master) if given.master else builder).getOrCreate()
    env = job.setdefault("env", {})
    if given.name:
        env["job.name"] = given.name
    if given.restore:
        env["restore.from"] = given.restore
    try:
        done = run_job(spark, job)
    except (JobError, rules.OptionError) as e:
        print(e, file=sys.stderr)
        return 1
    for q in done.results:
        if hasattr(q, "awaitTermination"):
            q.awaitTermination()
    print(json.dumps(done.metrics))
    return 0


if __name__ == "__main__":
    sys.exit(main())
