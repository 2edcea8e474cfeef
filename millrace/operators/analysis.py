"""Report totals, gap baselines, samples, budgets and the analysis of run logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workers import written


def report_counts(reports: DataFrame, column: str) -> DataFrame:
    """(value, n) of a column of reports."""
    return reports.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def report_map_sum(reports: DataFrame, column: str) -> DataFrame:
    """(value, n): sums over a map column, such as hits by rule."""
    return reports.select(F.explode(column).alias("value", "k")).groupBy("value").agg(F.sum("k").alias("n"))


def report_pages(reports: DataFrame, page: str, values: Column) -> DataFrame:
    """(value, page, n): the pages of every value, and how often it stands there. A row a page, so a hot value is no wide row."""
    return reports.select(F.col(page).alias("page"), F.explode(values).alias("value")).groupBy("value", "page").agg(F.count("*").alias("n"))


def gap_diff(gaps: DataFrame, baseline: DataFrame, held: DataFrame) -> DataFrame:
    """(page, kind, value, change): gaps that are new or fixed against the accepted baseline, on held pages only."""
    keys = ["page", "kind", "value"]
    now = gaps.select(*keys).distinct().withColumn("_now", F.lit(True))
    old = baseline.select(*keys).distinct().join(held, "page", "left_semi").withColumn("_old", F.lit(True))
    both = now.join(old, keys, "full_outer")
    change = F.when(F.col("_old").isNull(), "new").when(F.col("_now").isNull(), "fixed")
    return both.select(*keys, change.alias("change")).where("change is not null")


def gap_update(gaps: DataFrame, baseline: DataFrame, held: DataFrame) -> DataFrame:
    """The next baseline: gaps of held pages, and the old entries of the others."""
    return gaps.select("page", "kind", "value").distinct().union(baseline.select("page", "kind", "value").join(held, "page", "left_anti"))


def stratified_sample(rows: DataFrame, key: str, stratum: str, k: int, seed: int) -> DataFrame:
    """k rows, one per stratum a round, rows and strata in seeded order.

    Only the first k rows of a stratum can be taken, so ranks are cut at k before the strata meet.
    """
    drawn = lambda c: F.md5(F.concat(F.lit(f"{seed}|"), F.col(c).cast("string")).cast("binary"))
    ranked = rows.withColumn("round", F.row_number().over(Window.partitionBy(stratum).orderBy(drawn(key), key))).where(F.col("round") <= k)
    return ranked.orderBy("round", drawn(stratum), stratum).limit(k)


def sample_outcome(sample: DataFrame, pages: DataFrame, key: str) -> DataFrame:
    """sample with what its page gave, or an error if it is not held."""
    return sample.join(pages, key, "left").withColumn("error", F.when(F.col("outcome").isNull(), "page not held"))


def fetch_budget(wanted: DataFrame, held: DataFrame, key: str, listings: int, retries: int) -> DataFrame:
    """(unheld, worst_case): pages to fetch, and requests at worst: one first, each twice, switches up to the listings', all retried."""
    n = wanted.select(key).distinct().join(held.select(key), key, "left_anti").agg(F.count("*").alias("unheld"))
    return n.withColumn("worst_case", (1 + 2 * F.col("unheld") + F.least("unheld", F.lit(listings))) * (1 + retries))


def log_message(line: Column) -> Column:
    """The message of a log line: colours and the two leading fields removed."""
    return F.element_at(F.split(F.regexp_replace(line, r"\x1b\[[0-9;]*m", ""), r" \| ", 3), -1)


def log_tally(log: DataFrame) -> DataFrame:
    """Requests, completed, failed and skipped by run of log(run, seq, kind)."""
    return log.groupBy("run").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in ("request", "completed", "failed", "skipped")])


#: Columns of segmented(): the segment, in the order of its run.
SEGMENT = "_seg"


def segmented(log: DataFrame, *kinds: str) -> DataFrame:
    """The rows of log(run, seq, kind) of these kinds, dealt by ranges of run and seq and written so: a segment is one range, in which a run's rows
    stand together, so a long run is many segments and a small one shares its own with others."""
    n = int(log.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(log.where(F.col("kind").isin(*kinds)).select("run", "seq", "kind").repartitionByRange(n, "run", "seq").withColumn(SEGMENT, F.spark_partition_id()))


def _carried(rows: DataFrame, **sums: Column) -> DataFrame:
    """rows with, for each sum over its run's rows, what earlier segments have of it: one row a run and segment is all that is ordered."""
    each = rows.groupBy("run", SEGMENT).agg(*[F.sum(c).alias(f"_{k}") for k, c in sums.items()])
    before = Window.partitionBy("run").orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    carried = each.select("run", SEGMENT, *[F.coalesce(F.sum(f"_{k}").over(before), F.lit(0)).alias(f"{k}_before") for k in sums])
    return rows.join(carried, ["run", SEGMENT])


def _running(rows: DataFrame, **sums: Column) -> DataFrame:
    """rows with the sum of each column over the run so far: within the segment, and what earlier ones carry."""
    own = Window.partitionBy("run", SEGMENT).orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return _carried(rows, **sums).withColumns({k: F.col(f"{k}_before") + F.sum(c).over(own) for k, c in sums.items()}).drop(*[f"{k}_before" for k in sums])


def _streaks(rows: DataFrame, hit: Column) -> DataFrame:
    """rows with streak: hits in a row up to each row of the run. A segment's summary is its hits after the last miss, or all of them without one;
    they add up over segments since the last with a miss."""
    one = hit.cast("int")
    own = Window.partitionBy("run", SEGMENT).orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = rows.withColumn("_misses", F.sum(1 - one).over(own)).withColumn("_hit", one)
    misses = marked.groupBy("run", SEGMENT).agg(F.max("_misses").alias("m"))
    last = marked.join(misses.select("run", SEGMENT, "m"), ["run", SEGMENT]).where("_misses = m")
    tail = last.groupBy("run", SEGMENT, "m").agg(F.sum("_hit").alias("tail"))
    in_order = Window.partitionBy("run").orderBy(SEGMENT)
    since = tail.withColumn("_g", F.sum((F.col("m") > 0).cast("int")).over(in_order))
    summed = since.withColumn("_out", F.sum("tail").over(Window.partitionBy("run", "_g").orderBy(SEGMENT)))
    carried = summed.select("run", SEGMENT, F.coalesce(F.lag("_out").over(in_order), F.lit(0)).alias("_in"))
    stretch = Window.partitionBy("run", SEGMENT, "_misses").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    streak = F.sum("_hit").over(stretch) + F.when(F.col("_misses") == 0, F.col("_in")).otherwise(0)
    return marked.join(carried, ["run", SEGMENT]).withColumn("streak", streak)


def _first(rows: DataFrame, stop: Column) -> DataFrame:
    return rows.where(stop).groupBy("run").agg(F.min("seq").alias("seq"))


def throttle_streak(log: DataFrame, length: int = 3) -> DataFrame:
    """(run, seq) of the first throttled answer that makes `length` in a row; stored pages and plain answers reset, others are neutral."""
    rows = segmented(log, "throttle", "stored", "plain")
    return _first(_streaks(rows, F.col("kind") == "throttle"), (F.col("streak") >= length) & (F.col("kind") == "throttle"))


def failure_rate_stop(log: DataFrame, least: int = 3, per: int = 10) -> DataFrame:
    """(run, seq): where first at least `least` failed and failures times `per` exceed what was processed."""
    rows = _running(segmented(log, "completed", "failed", "skipped"), failed=(F.col("kind") == "failed").cast("int"), processed=F.lit(1))
    return _first(rows, (F.col("failed") >= least) & (F.col("failed") * per > F.col("processed")))


def challenge_switch(log: DataFrame, in_row: int = 3, ratio: float = 0.2, least: int = 10) -> DataFrame:
    """(run, seq): where plain fetching gives way: challenges in a row, or their share of at least `least` fetches too high."""
    hit = F.col("kind") == "challenge"
    rows = _streaks(_running(segmented(log, "challenge", "plain", "stored"), challenges=hit.cast("int"), fetches=F.lit(1)), hit)
    return _first(rows, (F.col("streak") >= in_row) | ((F.col("fetches") >= least) & (F.col("challenges") > ratio * F.col("fetches"))))
