from __future__ import annotations

import importlib.util
import json
import os

from barsmith.plans import inputs
from barsmith.sources import lineitem_bars as lb
from barsmith.sources.company_list import write_company_list
from tests.conftest import SF0001

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def load(name):
    spec = importlib.util.spec_from_file_location(name, os.path.join(ROOT, "jobs", f"{name}.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_run_job_cli(spark, scratch, capsys):
    companies = os.path.join(scratch, "companies")
    write_company_list(inputs.company_list(spark, SF0001), companies)
    landing = os.path.join(scratch, "landing")
    lb.payload_lines_from_bars(inputs.bars(spark, SF0001)).write.text(landing)
    out = os.path.join(scratch, "out")
    rc = load("run_job").main(["--input", companies, "--payloads", landing, "--output", out,
                               "--start-date", "1997-01-01", "--end-date", "1997-12-31"], spark=spark)
    assert rc == 0
    report = json.loads(capsys.readouterr().out)
    assert report["t1_winner"]["rank"] == 1 and report["validation"]["total_input"] > 0
    rc = load("run_job").main(["--output", os.path.join(scratch, "empty"), "--skip-ingestion"], spark=spark)
    assert rc == 1
