"""Packing from the command line: close, verify, plan a transfer, mark what was transferred."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import SparkSession

from gleaner.operators import records
from gleaner.plans import schemas
from gleaner.sources import scans, sinks


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="gleaner.batches", description=__doc__)
    p.add_argument("--data-dir", default="data/collection", type=Path)
    p.add_argument("--batch-gb", type=float, default=1)
    p.add_argument("--force-final", action="store_true")
    p.add_argument("--verify", action="store_true")
    p.add_argument("--prepare-transfer", action="store_true")
    p.add_argument("--transfer-plan", type=Path)
    p.add_argument("--mark-transferred", type=int)
    p.add_argument("--external-location")
    a = p.parse_args(argv)
    plan = a.transfer_plan or a.data_dir / "batches" / "transfer_plan.json"
    if a.mark_transferred is not None and not a.external_location:
        p.error("--mark-transferred needs --external-location")
    spark = spark or SparkSession.builder.appName("gleaner.batches").getOrCreate()
    packer = sinks.Packer(spark, a.data_dir / "batches", int(a.batch_gb * 2**30))
    if a.prepare_transfer:
        print(packer.transfer_plan(plan)["total_batches"])
    elif a.mark_transferred is not None:
        packer.mark_transferred(a.mark_transferred, a.external_location, plan)
    elif a.verify:
        print(len(packer.verify_all()))
    else:
        results = records.last_wins(scans.stored(spark, str(a.data_dir / "results"), schemas.RESULTS), "record_id", ["finished_at"])
        metadata = scans.stored(spark, str(a.data_dir / "records"), schemas.RECORDS).select("record_id", "payload")
        print(packer.close_all(results, metadata, a.force_final))
    return 0


if __name__ == "__main__":
    sys.exit(main())
