"""Time all queries of the library; print one JSON line.

Every query of the library runs in full (``noop`` sink) over the tables of
``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``: one run to warm up and one that is
timed.  The ``pipeline_*`` entries go the way of a real deployment: landed files
parsed, matched and stored, marts built from the raw table, reports read from the
marts.  What is written on the way is deleted at the end.
"""

from __future__ import annotations

import json
import os
import shutil
import statistics
import sys
import tempfile
import time
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import functions as F

from jobtide.plans import build, ingest, reports
from jobtide.schemas import RAW
from jobtide.session import build_session
from jobtide.sources.tables import read_raw, upsert_snapshot
from jobtide.sources.taxonomy import default_skills, default_taxonomy
from jobtide.verification import payloads
from jobtide.verification.postings import raw_postings
from jobtide.verification.registry import QUERIES, Relations

RUNS = 1


def timed(run) -> float:
    run()
    seconds = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def full(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    # One process on one machine, so a folder of this machine is shared.
    shared = tempfile.mkdtemp(prefix="jobtide-bench-")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.checkpoint.dir": shared,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    names = sys.argv[1:] or list(QUERIES)
    times = {}
    for name in names:
        query = QUERIES[name]
        times[name] = timed(lambda: full(query.build(Relations(spark, sf_dir))))

    if not sys.argv[1:]:
        root = f"{shared}/pipeline"
        raw = raw_postings(spark, sf_dir).withColumns(
            {
                "fetched_at": F.col("fetched_at").cast("timestamp"),
                "snapshot_date": F.col("snapshot_date").cast("string"),
            }
        )
        landing, day = f"{root}/landing", "2026-02-16"
        pages = payloads.jobicy(raw_postings(spark, sf_dir))
        pages.select("value").write.text(f"{landing}/{day}/jobicy", lineSep="\n")
        # A landed file is one document.
        folder = Path(landing, day, "jobicy")
        lines = [x for f in sorted(folder.glob("part-*")) for x in f.read_text("utf-8").splitlines()]
        for file in folder.iterdir():
            file.unlink()
        for number, line in enumerate(lines):
            (folder / f"{number}.json").write_text(line, "utf-8")
        skills, moment = default_skills(), datetime(2026, 2, 16, 9, tzinfo=timezone.utc)
        times["pipeline_ingest"] = timed(
            lambda: ingest.run_ingestion(
                spark, landing, f"{root}/ingested", f"{root}/archive", day, moment, skills, ["jobicy"]
            )
        )
        table, marts = f"{root}/raw", f"{root}/marts"
        taxonomy = default_taxonomy(spark)
        times["pipeline_upsert"] = timed(
            lambda: upsert_snapshot(raw.select(*RAW.names), table)
        )
        built = {}
        times["pipeline_build_marts"] = timed(
            lambda: built.update(build.build_marts(read_raw(spark, table), taxonomy, marts))
        )
        times["pipeline_kpi_row"] = timed(
            lambda: full(reports.kpi_row(built["fct_job_postings"], built["agg_skill_demand"]))
        )
        times["pipeline_explorer"] = timed(
            lambda: full(reports.explorer(built["fct_job_postings"], "engineer"))
        )

    print(
        json.dumps(
            {
                "metric": "all_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()
    shutil.rmtree(shared, ignore_errors=True)


if __name__ == "__main__":
    main()
