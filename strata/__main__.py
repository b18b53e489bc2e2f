"""Command line entry point for the layer jobs.

    spark-submit --py-files strata.zip -m strata run-all --root <warehouse> --source <csv folder>
    python -m strata load-raw   --root <warehouse> --source <csv folder> [--mode append]
    python -m strata load-clean --root <warehouse> [--mode append]
    python -m strata build-model --root <warehouse>
    python -m strata audit | reconcile | discarded | check --root <warehouse> [--run <run id>]
    python -m strata expire --root <warehouse> [--keep 2]

Under spark-submit the session (master, checkpoint folder, memory) comes
from the submit configuration; ``--local N`` starts a local session instead.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from strata.plans.pipeline import Warehouse
from strata.session import build_session, ensure_checkpoint_dir


def _session(local: int | None) -> SparkSession:
    if local:
        return build_session(master=f"local[{local}]", shuffle_partitions=max(8, 2 * local))
    spark = SparkSession.builder.appName("strata").getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="strata")
    p.add_argument("command", choices=["run-all", "load-raw", "load-clean", "build-model", "audit", "reconcile", "discarded", "check", "expire"])
    p.add_argument("--root", required=True, help="warehouse folder (any Hadoop file system path)")
    p.add_argument("--source", help="folder holding the nine CSV exports")
    p.add_argument("--mode", default="overwrite", choices=["overwrite", "append"])
    p.add_argument("--run", help="audit: this run only")
    p.add_argument("--keep", type=int, default=2, help="expire: manifests that stay readable")
    p.add_argument("--local", type=int, default=None, help="run on local[N] instead of the submitted cluster")
    a = p.parse_args(argv)

    spark = _session(a.local)
    wh = Warehouse(spark, a.root)
    if a.command in ("run-all", "load-raw") and not a.source:
        p.error("--source is required for " + a.command)
    if a.command == "run-all":
        rows = wh.run_all(source_dir=a.source, mode=a.mode)
    elif a.command == "load-raw":
        wh.create_layers()
        rows = wh.load_raw(source_dir=a.source, mode=a.mode)
    elif a.command == "load-clean":
        rows = wh.load_clean(mode=a.mode)
    elif a.command == "build-model":
        rows = wh.build_model()
    elif a.command == "expire":
        rows = [{"removed": r} for r in wh.expire_runs(a.keep)]
    else:
        audit = lambda: wh.audit() if a.run is None else wh.audit().where(F.col("run_id") == a.run)
        df = {"audit": audit, "reconcile": wh.reconcile, "discarded": wh.discarded, "check": wh.check_objects}[a.command]()
        for row in df.toLocalIterator():
            print(json.dumps(row.asDict(), default=str))
        return 0
    for r in rows:
        print(json.dumps(r, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
