"""Times the layer builds and the queries at one scale; prints one JSON line.

Layer builds write every table of the layer. Queries are run to the end without collecting rows.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import DAY, lake_of, registered  # noqa: E402
from sedimenta.plans import analytics, marts, star  # noqa: E402
from sedimenta.plans.lake import shared_folder  # noqa: E402
from sedimenta.plans.layers import run_layers  # noqa: E402
from sedimenta.plans.specs import WIDE_SPECS  # noqa: E402
from sedimenta.sources.retail import RetailSource  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# From the source files each time; the rest reads the stored star.
FROM_SOURCE = ["std_visualizacoes", "silver_visualizacoes", "silver_assinaturas", "silver_transmissoes", "dq_report"]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = session()
    spark.range(1_000_000).selectExpr("sum(id)").collect()
    lake, queries = lake_of(spark, FOLDER), registered()
    seconds = {
        "build_silver": timed(lambda: lake.build_all(list(WIDE_SPECS))),
        "build_dimensions": timed(lambda: lake.build_all(list(star.DIMENSIONS))),
        "build_facts": timed(lambda: lake.build_all(list(star.FACTS))),
        "build_marts": timed(lambda: lake.build_all(list(marts.MARTS))),
    }
    for name in [*FROM_SOURCE, "lookup_hot_keys", "fact_unknown_fk_counts", *analytics.QUERIES]:
        run = queries[name]
        seconds[name] = timed(lambda: run(spark, FOLDER).write.format("noop").mode("overwrite").save())
    root = f"{shared_folder(spark)}/bench-layers-{spark.sparkContext.applicationId}"
    source = RetailSource(spark, FOLDER)
    seconds["all_layers_from_csv"] = timed(lambda: run_layers(spark, source, root, DAY, specs=WIDE_SPECS))
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "all layer builds and queries",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": Path(FOLDER).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
