"""Batch jobs for ``spark-submit`` (the reference's three command-line stages).

    spark-submit --py-files civicflow.zip run_job.py clean --sf-dir DIR --view ev --out PATH
    spark-submit --py-files civicflow.zip run_job.py sql --clean PATH [--monthly PATH] --out DIR
    spark-submit --py-files civicflow.zip run_job.py model --clean PATH --model PATH --out DIR

(``python -m civicflow.jobs ...`` does the same on a local session.)

Each job reads, transforms and writes with Spark; only small report rows are
printed.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from .operators import explore as X
from .operators.observed import observe_cleaning
from .plans import model as M
from .plans import performance as P
from .session import build_session, configure
from .sources import export_results, read_clean, requests_ev, requests_ord
from .sources.tickets import load_table, write_table

VIEWS = {"ev": requests_ev, "ord": requests_ord}


def clean_job(spark: SparkSession, sf_dir: str, out: str, view: str = "ev",
              max_days: float = 90) -> dict:
    """Build the view, clean it (P18), write it partitioned by year/month (IO4)
    and return the cleaning report (P8, A12, A14, A17, A18).

    Everything but the exact median comes out of the write's own job: NULL
    counts before and after, outliers removed, profile and closed times are
    observed on the chain (``operators.observed``).  The median reads one
    column of the written table.
    """
    observed = observe_cleaning(VIEWS[view](spark, sf_dir), max_days)
    write_table(observed.clean, out, partition_by=["created_year", "created_month"], rebalance=False)
    report = observed.report()
    median = X.closed_time_stats(read_clean(spark, out)).select("median_days").first()[0]
    report["response_time"] |= {"median_days": median}
    report["profile"] = {k: str(v) for k, v in report["profile"].items()}
    return report


def sql_job(spark: SparkSession, clean_path: str, out_dir: str,
            monthly_path: str | None = None) -> dict:
    """Load the clean table (IO5), run Q1-Q6 (Q7) and export each (IO8)."""
    clean = load_table(spark, read_clean(spark, clean_path))
    monthly = read_clean(spark, monthly_path) if monthly_path else None
    try:
        results = P.run_all(clean, monthly_input=monthly)
    except P.QueryError as exc:
        export_results(exc.results, out_dir)
        raise
    return export_results(results, out_dir)


def model_job(spark: SparkSession, clean_path: str, model_path: str, out_dir: str,
              **forest_kw) -> dict:
    """Train, save, report and score (M15); ``forest_kw`` go to the forest fit."""
    clean = read_clean(spark, clean_path)
    res = M.run_model_job(clean, model_path=model_path, **forest_kw)
    written = export_results({"report": res["report"], "top_features": res["top_features"]},
                             out_dir, prefix="model")
    # Scores have a row for each ticket: Parquet, not CSV.
    written["scored"] = write_table(res["scored"], f"{out_dir.rstrip('/')}/model_scored")
    return {"written": written,
            "report": [r.asDict() for r in res["report"].collect()]}


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="civicflow.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    c = sub.add_parser("clean")
    c.add_argument("--sf-dir", required=True)
    c.add_argument("--view", choices=sorted(VIEWS), default="ev")
    c.add_argument("--out", required=True)
    c.add_argument("--max-days", type=float, default=90)
    s = sub.add_parser("sql")
    s.add_argument("--clean", required=True)
    s.add_argument("--monthly")
    s.add_argument("--out", required=True)
    m = sub.add_parser("model")
    m.add_argument("--clean", required=True)
    m.add_argument("--model", required=True)
    m.add_argument("--out", required=True)
    a = ap.parse_args(argv)

    active = SparkSession.getActiveSession()
    spark = configure(active) if active else build_session(app=f"civicflow-{a.job}")
    if a.job == "clean":
        out = clean_job(spark, a.sf_dir, a.out, a.view, a.max_days)
    elif a.job == "sql":
        out = sql_job(spark, a.clean, a.out, a.monthly)
    else:
        out = model_job(spark, a.clean, a.model, a.out)
    print(json.dumps(out, default=str))


if __name__ == "__main__":
    main()
