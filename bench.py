"""Time the headline queries; prints one JSON line.

Each query is run to the end (noop sink, so every column of every row is produced) twice; the better
run counts, because the first one also pays for class loading and compilation.
"""

from __future__ import annotations

import json
import os
import re
import time
from pathlib import Path

from plumbline.session import build_session
from workload import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "row_checks",
    "row_violations",
    "uniqueness_lineitem",
    "uniqueness_violations",
    "fk_violations",
    "fk_fuzzy",
    "contains_texts",
    "expand_columns",
    "quantiles_99",
    "theil_sen",
    "ratio_repair",
    "mice",
    "coherence_numeric",
    "coherence_text",
    "coherence_vectors",
    "g3_scores",
    "fd_search",
    "connected_components",
    "dedup_documents",
    "dedup_parts",
    "two_branch_avg",
    "upsert_keep_last",
    "scorecard",
)


def timed(name: str, spark) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(
        "plumbline-bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {name: round(min(timed(name, spark) for _ in range(2)), 3) for name in HEADLINE}
    scale = re.search(r"sf([\d.]+)", Path(SF_DIR).name)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else SF_DIR,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
