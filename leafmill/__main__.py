"""python -m leafmill STAGE ...: ingest, read, review, assemble, all, status, todo."""

from __future__ import annotations

import argparse
import json
import signal
import sys

from pyspark.sql import SparkSession

from leafmill import stages
from leafmill.operators.review import Policy
from leafmill.sources.files import split_inputs
from leafmill.sources.models import ChatEndpoint, StopFlag


def options() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="python -m leafmill", description=__doc__)
    sub = top.add_subparsers(dest="stage", required=True)
    for name in ("ingest", "read", "review", "assemble", "all", "status", "todo"):
        p = sub.add_parser(name)
        p.add_argument("--work", default="work", help="folder of the tables, shared by driver and executors")
        p.add_argument("--force", action="store_true", help="do finished pages again")
        if name in ("ingest", "all"):
            p.add_argument("--inputs", nargs="+", required=True, help="files, folders, @lists")
            p.add_argument("--dpi", type=int, default=200)
        if name in ("read", "all"):
            p.add_argument("--reader", default="layout-json")
            p.add_argument("--reader-url", default="http://127.0.0.1:8001/v1")
            p.add_argument("--reader-model")
            p.add_argument("--reader-extra", type=json.loads, default={}, help="JSON for every request's body")
            p.add_argument("--prompt", default="Transcribe this page.")
            p.add_argument("--retries", type=int, default=1)
        if name in ("read", "all", "todo"):
            p.add_argument("--retry-failed", action="store_true")
        if name in ("review", "all"):
            p.add_argument("--reviewer-url", default="http://127.0.0.1:8002/v1")
            p.add_argument("--reviewer-model")
            p.add_argument("--reviewer-extra", type=json.loads, default={})
            p.add_argument("--review-types", default="formula")
            p.add_argument("--no-flagged", action="store_true")
            p.add_argument("--max-change", type=float, default=0.35)
            p.add_argument("--max-change-flagged", type=float, default=0.6)
            p.add_argument("--no-describe-figures", action="store_true")
        if name in ("read", "review", "all"):
            p.add_argument("--workers", type=int, default=32)
        if name in ("assemble", "all"):
            p.add_argument("--out", default="out")
            p.add_argument("--no-page-markers", action="store_true")
        if name == "todo":
            p.add_argument("--of", choices=["read", "review"], required=True)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None, reader=None, reviewer=None) -> int:
    """Exit codes: 0 done, 2 wrong use, 3 a server or the system failed, 85 stopped. Models other
    than HTTP endpoints can be given."""
    a = options().parse_args(argv)
    spark = spark or SparkSession.builder.getOrCreate()
    root = stages.local(a.work)
    flag = StopFlag(f"{root}.stop")
    flag.clear()
    previous = {}
    for s in (signal.SIGTERM, signal.SIGUSR1):
        try:
            previous[s] = signal.signal(s, lambda *_: flag.set())
        except ValueError:  # not the main thread
            pass
    work = stages.Work(spark, root, stop=flag)

    def read():
        model = reader or ChatEndpoint(a.reader_url, a.reader_model, **a.reader_extra)
        work.read(model, a.reader, a.reader_model or "model", a.prompt, a.retries, a.force, a.retry_failed, workers=a.workers)

    def review():
        model = reviewer or ChatEndpoint(a.reviewer_url, a.reviewer_model, **a.reviewer_extra)
        policy = Policy(tuple(t for t in a.review_types.split(",") if t), not a.no_flagged, a.max_change, a.max_change_flagged)
        work.review(model, a.reviewer_model or "model", policy, a.force, not a.no_describe_figures, workers=a.workers)

    def todo():
        print((work.to_read(a.force, a.retry_failed) if a.of == "read" else work.to_review(a.force)).count())

    each = {
        "ingest": lambda: work.ingest(split_inputs(a.inputs), a.dpi, a.force),
        "read": read,
        "review": review,
        "assemble": lambda: work.assemble(stages.local(a.out), not a.no_page_markers),
        "status": lambda: print(work.status_text()),
        "todo": todo,
    }
    names = ["ingest", "read", "review", "assemble"] if a.stage == "all" else [a.stage]
    try:
        return stages.run(work, [(each[n], {}) for n in names])
    finally:
        for s, before in previous.items():
            signal.signal(s, before)
        flag.clear()


if __name__ == "__main__":
    sys.exit(main())
