"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

``queries`` times this engine. ``naive`` times the reference's own query shape for five of them, on the same data.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable
from statistics import median

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlift import discard_durables, get_session
from rosterlift.functions.contact import email_norm, linkedin_norm, phone_norm
from rosterlift.plans.candidates import build_candidates
from rosterlift.quality.checks import compile_checks
from rosterlift.quality.contracts import CONTRACTS, GLOBAL_RULES
from workload import QUERIES
from workload.base import CTX, Tables
from workload.table_queries import marks

HEADLINE = ("f07_clean_html", "j11_match_any_key", "j20_not_in", "j23_nearest_in_time", "u03_unpivot", "w01_keep_first",
            "w09_positions", "w14_numbered_links", "h02_last_non_rejected", "e04_people_two_lists",
            "e06_person_identities", "e08_companies", "e12_experiences", "e14_projects", "e17_candidates",
            "e17_candidates_history", "e18_person_notes", "e20_channel_meetings", "e24_attribute_values",
            "e26_project_fees", "q30_rule_report", "q31_samples", "c04_field_diff", "c06_summary")


def run_to_end(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(job: Callable[[], None]) -> float:
    start = time.perf_counter()
    job()
    return round(time.perf_counter() - start, 3)


def naive_forms(spark: SparkSession, folder: str) -> dict[str, Callable[[], None]]:
    def suite() -> None:
        t = Tables(spark, folder)
        rows = build_candidates(t.applications, t.projects, t.people, t.users, CTX, marks(),
                                t.applications.select("id", "status", "added_at"))
        for check in compile_checks("candidates_x", rows.schema, CONTRACTS["candidates*"], GLOBAL_RULES):
            if check.kind == "rows":
                rows.where(check.bad).agg(F.count(F.lit(1))).collect()
            elif check.kind == "unique":
                rows.agg(F.count(check.column) - F.count_distinct(check.column)).collect()

    def or_match() -> None:
        t = Tables(spark, folder)

        def keyed(df: DataFrame, p: str) -> DataFrame:
            keys = (("e", email_norm("email")), ("p", phone_norm("phone")), ("l", linkedin_norm("linkedin")))
            return df.select(F.col("id").alias(f"{p}id"), *[F.nullif(c, F.lit("")).alias(p + n) for n, c in keys])
        same = (F.col("re") == F.col("le")) | (F.col("rp") == F.col("lp")) | (F.col("rl") == F.col("ll"))
        pairs = keyed(t.contact_people, "l").join(keyed(t.candidate_people, "r"), same)
        run_to_end(pairs.groupBy("lid").agg(F.min("rid")))

    def branches() -> None:
        t = Tables(spark, folder)
        values = {"email": email_norm("email"), "phone": phone_norm("phone"), "mobile": phone_norm("mobile"),
                  "linkedin": linkedin_norm("linkedin")}
        parts = [t.contacts.select("id", F.lit(k).alias("type"), v.alias("value")).where("value IS NOT NULL")
                 for k, v in values.items()]
        run_to_end(parts[0].union(parts[1]).union(parts[2]).union(parts[3]))

    def self_join() -> None:
        t = Tables(spark, folder)
        t.history.createOrReplaceTempView("bench_history")
        run_to_end(spark.sql("""
            WITH o AS (SELECT *, row_number() OVER (PARTITION BY person_id, project_id ORDER BY ts DESC, event_id DESC) rn FROM bench_history),
            le AS (SELECT * FROM o WHERE rn = 1),
            p AS (SELECT h.person_id, h.project_id, h.status, row_number() OVER (PARTITION BY h.person_id, h.project_id
                  ORDER BY h.ts DESC, h.event_id DESC) r2 FROM bench_history h JOIN le ON le.person_id = h.person_id
                  AND le.project_id = h.project_id WHERE struct(h.ts, h.event_id) < struct(le.ts, le.event_id)
                  AND h.status NOT IN ('error', 'click'))
            SELECT le.person_id, le.project_id, le.status, coalesce(p.status, 'Added') FROM le LEFT JOIN p
            ON p.person_id = le.person_id AND p.project_id = le.project_id AND p.r2 = 1"""))

    def not_in() -> None:
        t = Tables(spark, folder)
        t.postings.createOrReplaceTempView("bench_postings")
        run_to_end(spark.sql("SELECT id FROM bench_postings WHERE id NOT IN "
                             "(SELECT linked_id FROM bench_postings WHERE linked_id IS NOT NULL)"))

    return {"q30_rule_report": suite, "j11_match_any_key": or_match, "u03_unpivot": branches,
            "h02_last_non_rejected": self_join, "j20_not_in": not_in}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session("bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus,
                                                      "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    run_to_end(QUERIES["j01_drop_orphans"](spark, folder))  # start-up and code generation are not what is timed
    times = {}
    for name in HEADLINE:
        job = lambda name=name: run_to_end(QUERIES[name](spark, folder))
        timed(job)  # warm up
        times[name] = median(timed(job) for _ in range(3))
    naive = {}
    for name, job in naive_forms(spark, folder).items():
        timed(job)
        naive[name] = median(timed(job) for _ in range(3))
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "naive": naive, "sf": os.path.basename(folder.rstrip("/")), "cpus": int(cpus),
                      "spark": spark.version}))
    sys.stdout.flush()
    discard_durables(spark)


if __name__ == "__main__":
    main()
