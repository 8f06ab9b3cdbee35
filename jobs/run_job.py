"""Command line for the batch job (``spark-submit jobs/run_job.py ...``)."""
from __future__ import annotations

import argparse
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barsmith.plans.job import DEFAULT_END, DEFAULT_START, JobConfig, JobError, run  # noqa: E402
from barsmith.session import get_session  # noqa: E402


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description="Daily-bar analytics job")
    p.add_argument("--input", dest="companies_path", help="company list CSV (company_name,symbol)")
    p.add_argument("--payloads", dest="payloads_path", help="landed JSON-lines response envelopes")
    p.add_argument("--reference", dest="reference_path", help="ticker reference parquet (for --validate-tickers)")
    p.add_argument("--output", dest="output_dir", default="output", help="root output folder")
    p.add_argument("--start-date", default=DEFAULT_START)
    p.add_argument("--end-date", default=DEFAULT_END)
    p.add_argument("--validate-tickers", action="store_true")
    p.add_argument("--skip-ingestion", action="store_true")
    p.add_argument("--investment-per-stock", type=float, default=10_000.0)
    p.add_argument("--profile", choices=("local", "cluster"), default="local",
                   help="cluster: large-scale shuffle/split sizing (see barsmith.session.CLUSTER_CONF)")
    return p.parse_args(argv)


def main(argv=None, spark=None) -> int:
    """Run the job; a caller-owned ``spark`` session is used and left open."""
    a = parse_args(argv)
    cfg = JobConfig(output_dir=a.output_dir, companies_path=a.companies_path, payloads_path=a.payloads_path,
                    reference_path=a.reference_path, start_date=a.start_date, end_date=a.end_date,
                    validate_tickers=a.validate_tickers, skip_ingestion=a.skip_ingestion,
                    investment_per_stock=a.investment_per_stock)
    owned = spark is None
    spark = spark or get_session("barsmith-job", profile=a.profile)
    try:
        print(json.dumps(run(spark, cfg), default=str, indent=2))
    except JobError as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    finally:
        if owned:
            spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
