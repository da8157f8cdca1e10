"""Times the headline queries over BENCH_SF_DIR (default sf0.1) on local[BENCH_CPUS] and prints one JSON line."""

import json
import os
import time

from pyspark.sql import SparkSession

from lectern import catalog

#: Headline queries: features, rules, joins, aggregation, pages, references, windows, alignment.
HEADLINE = ["block_kind_counts", "block_features", "stylistic_issues", "review_issue_rollup", "issue_dedup", "weight_chunks", "glossary_discouraged", "candidate_aggregate", "review_triage", "page_links", "page_manifest", "reference_resolution", "chapter_pairing", "apply_validation", "align_opcodes"]


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    took = {}
    for name in HEADLINE:
        began = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
