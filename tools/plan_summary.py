"""Summarise the physical plan of every registered query (markdown table).

    python tools/plan_summary.py [sf_dir] > PLANS.md
"""

import re
import sys

sys.path.insert(0, ".")

PATTERNS = {
    "hash_exch": r"Exchange hashpartitioning",
    "range_exch": r"Exchange rangepartitioning",
    "single_exch": r"Exchange SinglePartition",
    "bcast": r"BroadcastExchange",
    "partial_aggs": r"(HashAggregate|SortAggregate)\(keys?=\[[^\]]*\], functions=\[partial_",
    "smj": r"SortMergeJoin",
    "bhj": r"BroadcastHashJoin",
    "window": r"\bWindow \[",
    "scans": r"FileScan parquet",
}


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    from pyspark.sql import SparkSession

    from vehicle_metrics.plans.queries import QUERIES
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "16").config("spark.sql.autoBroadcastJoinThreshold", "-1")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    print(f"Physical plans at {sf_dir} with static broadcasts disabled (the shape a large input gets "
          "before AQE re-plans; AQE may still convert a join to broadcast after measuring a side).\n")
    print("| query | " + " | ".join(PATTERNS) + " | pushed filters |")
    print("|---" * (len(PATTERNS) + 2) + "|")
    for name, q in QUERIES.items():
        plan = q(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        counts = [str(len(re.findall(p, plan))) for p in PATTERNS.values()]
        pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]+)\]", plan)))
        print(f"| {name} | " + " | ".join(counts) + f" | {'; '.join(pushed) or '-'} |")


if __name__ == "__main__":
    main()
