"""Time the headline queries; print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3). ``queries`` has the best run of each query and
``medians`` the median; ``naive`` has the best run of the plain Spark form of
the same question, in the same session: every point against every polygon,
groups collected and compared in a driver loop, an unclustered scan. Each query
is run to completion with the ``noop`` sink, so the timing covers the whole plan
without moving results to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from fieldatlas import fixtures as fx  # noqa: E402
from fieldatlas.functions.geo import contains_point, polygon_edges  # noqa: E402
from fieldatlas.plans import catalog  # noqa: E402
from fieldatlas.plans.catalog import QUERIES  # noqa: E402
from fieldatlas.session import release_tables  # noqa: E402

HEADLINE = [
    "diverse_communities",
    "spatial_join_counts",
    "spatial_join_detailed",
    "spatial_join_shuffled",
    "similar_communities_top10",
    "species_distinct_with_nulls",
    "nearest_places",
    "flights_filter_sort",
    "geojson_object_root",
    "clustered_scan",
    "write_count",
]


def session(cpus: str) -> SparkSession:
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("fieldatlas-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(int(cpus) * 2))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
    )
    spark = b.getOrCreate()
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.getCheckpointDir() is None:
        # Only where unset (a single machine): register a local shared folder.
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="fieldatlas-bench-"))
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def naive_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every point against every polygon, spread over the cores."""
    polygons = fx.communities(spark, sf_dir).select("community", polygon_edges("rings").alias("e"))
    points = fx.occurrences(spark, sf_dir).repartition(spark.sparkContext.defaultParallelism)
    return points.crossJoin(F.broadcast(polygons)).where(contains_point("e", "lon", "lat")).drop("e")


def naive_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Species sets collected to the driver and compared in a loop."""
    sets = naive_join(spark, sf_dir).groupBy("community").agg(F.collect_set("species").alias("s"))
    top = sets.orderBy(F.size("s").desc(), "community").limit(10).collect()
    pairs = []
    for i, a in enumerate(top):
        for b in top[i + 1 :]:
            both = len(set(a.s) & set(b.s))
            pairs.append((a.community, b.community, both / (len(a.s) + len(b.s) - both)))
    pairs.sort(key=lambda p: (-p[2], p[0], p[1]))
    return spark.createDataFrame(pairs[:10], "community_1 string, community_2 string, similarity double")


def naive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    x0, y0, x1, y1 = catalog.BOX
    return fx.occurrences(spark, sf_dir).where(F.col("lon").between(x0, x1) & F.col("lat").between(y0, y1))


NAIVE = {
    "diverse_communities": lambda s, d: naive_join(s, d).groupBy("community").agg(F.count_distinct("species")).orderBy(F.lit(1)).limit(10),
    "spatial_join_counts": lambda s, d: naive_join(s, d).groupBy("community").count(),
    "similar_communities_top10": naive_similarity,
    "clustered_scan": naive_scan,
}


def timed(spark: SparkSession, query, sf_dir: str, repeat: int) -> list[float]:
    times = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - t0)
        release_tables(spark)
    return times


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = session(cpus)
    # Warm-up (untimed): JVM class loading, JIT and code generation of the
    # join and aggregation paths are not part of any one query.
    for name in ("boundaries_edges", "spatial_join_counts"):
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    runs = {name: timed(spark, QUERIES[name], sf_dir, repeat) for name in HEADLINE}
    times = {name: round(min(t), 3) for name, t in runs.items()}
    naive = {name: round(min(timed(spark, query, sf_dir, repeat)), 3) for name, query in NAIVE.items()}
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "medians": {name: round(median(t), 3) for name, t in runs.items()},
                "naive": naive,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
