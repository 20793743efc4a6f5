"""Skew check: how much of a hot group does any single task receive?

Derives skewed inputs from the driver tables:
  * hot film   -- a third of all ratings (line items) belong to one film;
  * hot ties   -- a third of all films share the top average of their decade.
Runs the cinelens operator and a window-based formulation of the same result
on each, with Spark's event log written to a fresh scratch folder, and reports
per variant, for its worst stage, the rows read from shuffle by the busiest
task as a share of all rows that stage read. A share near 1/partitions means
the work stays spread; a share near or above 1/3 means one task received the
hot group. Partition coalescing is off here (it would merge small partitions
into one task on purpose) and the single-row-group test files are spread over
the map tasks first, as a multi-file input would be.

    BENCH_SF_DIR=/root/testdata/sf0.1 python benchmarks/skew_check.py

Prints one JSON line. Not part of the library.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from cinelens import plans as P  # noqa: E402
from cinelens.operators import dedup_by_key, top_per_group  # noqa: E402
from cinelens.session import get_session  # noqa: E402


def _lines(spark, d):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return spark.read.parquet(f"{d}/lineitem.parquet").repartition(parts)


def hot_film_ratings(spark, d):
    """(movieid, ratings): a third of the line items remapped to film 0."""
    li = _lines(spark, d)
    return li.select(
        F.when(F.pmod(F.col("l_partkey"), F.lit(3)) == 0, F.lit(0)).otherwise(F.col("l_orderkey"))
         .alias("movieid"),
        (F.col("l_quantity") / F.lit(10.0)).alias("ratings"))


def tied_film_averages(spark, d):
    """(title, average_rating, decade): a third of the films rated 5.0 exactly."""
    li = _lines(spark, d)
    o = spark.read.parquet(f"{d}/orders.parquet")
    r = li.select(F.col("l_orderkey").alias("movieid"),
                  F.when(F.pmod(F.col("l_orderkey"), F.lit(3)) == 0, F.lit(5.0))
                   .otherwise(F.col("l_quantity") / F.lit(10.0)).alias("ratings"))
    films = o.select(F.col("o_orderkey").alias("id"),
                     F.concat(F.lit("Order#"), F.col("o_orderkey").cast("string")).alias("title"),
                     F.col("o_orderdate").cast("date").alias("release_date"))
    return P.avg_ratings_with_title_year(r, films)


def window_mean(df):
    w = Window.partitionBy("movieid")
    return (df.select("movieid", F.avg("ratings").over(w).alias("average_rating"))
              .dropDuplicates(["movieid"]))


def window_best(df):
    d = df.select("title", F.col("average_rating").alias("highest_rating"),
                  F.concat(F.col("year_of_release").cast("string"), F.lit("s")).alias("decade"))
    w = Window.partitionBy("decade").orderBy(F.col("highest_rating").desc())
    return d.withColumn("rk", F.rank().over(w)).where("rk = 1").drop("rk")


def ours_best(df):
    d = df.select("title", F.col("average_rating").alias("highest_rating"),
                  F.concat(F.col("year_of_release").cast("string"), F.lit("s")).alias("decade"))
    return top_per_group(d, "decade", "highest_rating", broadcast_best=True)


def window_dedup(df):
    w = Window.partitionBy("movieid").orderBy(F.col("ratings").desc())
    return df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


VARIANTS = {
    "hot_film_mean/cinelens": (hot_film_ratings, lambda df: P.avg_rating_per_film(df)),
    "hot_film_mean/window": (hot_film_ratings, window_mean),
    "hot_film_dedup/cinelens": (hot_film_ratings,
                                lambda df: dedup_by_key(df, ["movieid"], ["ratings"], keep="last")),
    "hot_film_dedup/window": (hot_film_ratings, window_dedup),
    "hot_ties_best/cinelens": (tied_film_averages, ours_best),
    "hot_ties_best/window": (tied_film_averages, window_best),
}


def worst_stage_shares(log_dir):
    """job group -> (share, busiest task rows, stage rows) of its worst stage."""
    stage_group, per_stage = {}, {}
    paths = [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
             if os.path.isfile(p) and "appstatus" not in os.path.basename(p)]
    for path in sorted(paths):
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    rows = m.get("Total Records Read", 0)
                    per_stage.setdefault(ev["Stage ID"], []).append(rows)
    out = {}
    for sid, rows in per_stage.items():
        g, tot = stage_group.get(sid), sum(rows)
        if g is None or not tot:
            continue
        cand = (round(max(rows) / tot, 3), max(rows), tot)
        if g not in out or cand > out[g]:
            out[g] = cand
    return out


def main():
    d = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    log_dir = tempfile.mkdtemp(prefix="cinelens-eventlog-")
    spark = get_session(master=f"local[{cpus}]", app="skew-check", shuffle_partitions=cpus,
                        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                               "spark.eventLog.compress": "false",
                               "spark.sql.adaptive.coalescePartitions.enabled": "false",
                               "spark.driver.memory": "8g"})
    rows = {}
    for name, (source, op) in VARIANTS.items():
        df = op(source(spark, d))
        spark.sparkContext.setJobGroup(name, name)
        df.write.format("noop").mode("overwrite").save()
        spark.sparkContext.setJobGroup("count", "count")
        rows[name] = df.count()
    spark.stop()
    shares = worst_stage_shares(log_dir)
    result = {}
    for name in VARIANTS:
        share, mx, tot = shares.get(name, (0.0, 0, 0))
        result[name] = {"result_rows": rows[name], "worst_stage_busiest_task_rows": mx,
                        "worst_stage_rows": tot, "busiest_task_share": share}
    print(json.dumps({"sf_dir": d, "partitions": cpus, "variants": result}))


if __name__ == "__main__":
    main()
