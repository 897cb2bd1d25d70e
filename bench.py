"""Times every analysis query; prints one JSON line.  The first queries pay for the relations that all share."""

import json
import os
import time

from pyspark.sql import SparkSession

from synonymy.plans import registry, relations


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    spark.range(1000).selectExpr("sum(id)").collect()
    for name in sorted(registry.QUERIES):
        began = time.time()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    relations.clear(spark)
    print(json.dumps({"metric": "all analysis queries", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
