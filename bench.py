"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the cores. The ``stage_*`` entries repeat the stages of
the recorded baseline one by one, from a tab-separated file to the profiles; the others are catalog queries, run whole.
Every entry is the best of ``BENCH_RUNS`` runs after one warm-up run.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from traitloom.catalog import QUERIES, views
from traitloom.catalog.job_queries import SPEC
from traitloom.operators.aggregates import count_by
from traitloom.operators.filters import keep_flagged
from traitloom.operators.profile import numeric_profile
from traitloom.operators.setops import union_tagged
from traitloom.plans.enrich import integrate
from traitloom.plans.numbers import wide_numbers
from traitloom.plans.workflow import land_records
from traitloom.plans.stats import profiles
from traitloom.plans.text import wide_text
from traitloom.session import local_session
from traitloom.sources.readers import read_eav_tsv
from traitloom.sources.writers import write_eav_tsv

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

BASELINE = {"stage_parse": 2.217, "stage_text": 2.503, "stage_numbers": 2.783, "stage_integrate": 6.419}

HEADLINE = [
    "job_qual_wide",
    "job_quant_wide",
    "job_enrich",
    "job_stats_qual_by_site",
    "stat_quant_overall",
    "stat_quant_by_site",
    "stat_qual_overall",
    "stat_qual_by_site",
    "agg_distinct_rows",
    "agg_string_collapse_ordered",
    "agg_mean",
    "rsh_pivot_string",
    "rsh_pivot_mean",
    "rsh_unpivot_keep_null",
    "join_left_two_way",
    "flt_numeric_split",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def best(action) -> float:
    action()
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def stages(spark) -> dict[str, float]:
    folder = tempfile.mkdtemp(prefix="bench-")
    raw = views.records(spark, SF_DIR)
    tsv = write_eav_tsv(raw, f"{folder}/raw")
    schema = raw.schema
    times = {"stage_parse": best(lambda: land_records(read_eav_tsv(spark, tsv, schema), f"{folder}/records", SPEC))}
    records = spark.read.parquet(f"{folder}/records")

    def write(df, name):
        df.write.mode("overwrite").parquet(f"{folder}/{name}")

    times["stage_text"] = best(lambda: write(wide_text(records, SPEC), "text"))
    times["stage_numbers"] = best(lambda: write(wide_numbers(records, SPEC), "numbers"))
    text, numbers = spark.read.parquet(f"{folder}/text"), spark.read.parquet(f"{folder}/numbers")
    curated = views.curated(spark, SF_DIR)
    times["stage_integrate"] = best(lambda: write(integrate(curated, text, numbers, SPEC), "integrated"))
    traits = spark.read.parquet(f"{folder}/integrated")
    times["stage_profiles"] = best(lambda: [run(df) for df in profiles(traits, SPEC).values()])
    return times


def looped(spark) -> dict[str, float]:
    """The profiles in the obvious form, one filter and grouping per site and variable, for comparison."""
    df = views.flagged(spark, SF_DIR)

    def by_site(profile):
        return union_tagged({site: profile(keep_flagged(df, site)) for site in views.SITES})

    def frequencies(part):
        columns = ("flag", "status", "line", "ship_month")
        return union_tagged({c: count_by(part.withColumnRenamed(c, "value"), ["value"]) for c in columns}, "variable")

    numeric = by_site(lambda part: numeric_profile(part, ["quantity", "price", "discount"]))
    return {
        "stat_quant_by_site": best(lambda: run(numeric)),
        "stat_qual_by_site": best(lambda: run(by_site(frequencies))),
    }


def main() -> None:
    spark = local_session("bench", CPUS, os.environ.get("BENCH_MEMORY", "8g"))
    spark.sparkContext.setLogLevel("ERROR")
    times = stages(spark)
    for name in HEADLINE:
        times[name] = best(lambda: run(QUERIES[name](spark, SF_DIR)))
    loops = looped(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "looped": loops,
                "baseline": BASELINE,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
