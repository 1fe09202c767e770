"""Time the headline programs over gzip NDJSON and print one JSON line.

The input is staged once, untimed: one 78-field line per row of ``orders``, as gzip
files of which one name holds a third of the lines.  ``objects_per_sec`` is what the
runs: the first ones mostly measure the JVM compiling.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.fixtures import full_lines, gz_folder
from lacuna.operators.filters import lines_with_email_domain, lines_with_phone, phone_match_rate
from lacuna.operators.profile import (
    by_file,
    overall,
    profile_facts,
    profile_fields,
    status_counts,
    value_counts,
)
from lacuna.plans.jobs import clean_job, clean_with_totals, convert_job, profile_job
from lacuna.scratch import new_folder
from lacuna.session import local_session
from lacuna.sources.ndjson import parse_objects, scan_lines


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, "bench", spark__sql__shuffle__partitions=cpus, spark__driver__memory="12g")
    source = gz_folder(full_lines(spark, sf_dir))
    lines = scan_lines(spark, source)
    objects = lines.count()

    def all_rows(frame):
        frame.write.format("noop").mode("overwrite").save()

    programs = {
        "scan": lambda: all_rows(lines),
        "parse": lambda: all_rows(parse_objects(lines)),
        "profile_fields": lambda: profile_fields(parse_objects(lines)).collect(),
        "profile_by_file": lambda: by_file(profile_facts(parse_objects(lines))).collect(),
        "profile_overall": lambda: overall(profile_facts(parse_objects(lines))).collect(),
        "profile_job": lambda: profile_job(spark, source, new_folder(spark, "profile")),
        "value_counts": lambda: all_rows(value_counts(lines)),
        "status_counts": lambda: all_rows(status_counts(lines, "gender")),
        "clean_to_gzip": lambda: clean_with_totals(spark, source, new_folder(spark, "clean")),
        "clean_job": lambda: clean_job(spark, source, new_folder(spark, "clean")).collect(),
        "convert_wide": lambda: convert_job(spark, source, new_folder(spark, "wide")).collect(),
        "convert_narrow": lambda: convert_job(
            spark, source, new_folder(spark, "narrow"), "narrow"
        ).collect(),
        "convert_narrow_strings": lambda: convert_job(
            spark, source, new_folder(spark, "strings"), "narrow_strings"
        ).collect(),
        "filter_has_phone": lambda: all_rows(lines_with_phone(lines)),
        "filter_email_domain": lambda: all_rows(lines_with_email_domain(lines)),
        "phone_match_rate": lambda: phone_match_rate(lines).collect(),
    }
    seconds = {}
    for name, program in programs.items():
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            program()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sparse NDJSON programs, total time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "objects": objects,
                "objects_per_sec": {n: round(objects / s) for n, s in seconds.items()},
            }
        )
    )


if __name__ == "__main__":
    main()
