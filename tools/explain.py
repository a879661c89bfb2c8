"""Print the formatted physical plan of registered queries.

    python tools/explain.py [sf_dir] name [name ...]
"""

import sys

sys.path.insert(0, ".")


def main():
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    from pyspark.sql import SparkSession

    from vehicle_metrics.plans.queries import QUERIES
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "16").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    for name in args:
        print(f"===== {name}")
        QUERIES[name](spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main()
