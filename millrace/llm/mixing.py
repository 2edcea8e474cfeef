"""Mixing sources to target weights over a tree of domains, languages and sources.

The budget is divided from the root down: siblings share their parent's budget by weight, none beyond what it can
supply in max_epochs passes, and what one lacks goes to its siblings by weight before it goes further up. Each leaf
then takes whole seeded epochs and a prefix, in tokens, of one more epoch's order.

Only DataFrame expressions. Trees hold one row a node. A leaf's order is the md5 of seed, epoch and id; a histogram
over its first three hex digits finds the bucket where the prefix ends, and only that bucket's rows are summed one by
one, so a source with a third of all rows is never sorted in one task.

Defined results. Null text has no tokens, and a row without tokens is never taken. Null language or source is the
empty string. Rows that repeat an id stand together: all are taken or none. Nodes without a weight have weight 1;
weight 0 excludes. An empty table gives an empty result. Columns named n_tokens, n_epochs or domain are replaced, all
others stay, whatever their names. Long texts are only counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, cut

LEVELS = ("domain", "lang", "source")
#: Parts into which the rows of a leaf are dealt when they meet its plan.
SALTS = 32


def _shared(nodes: DataFrame, parents: list[str]) -> DataFrame:
    """Divide parent_budget among nodes(…, weight, capacity, parent_budget): column budget.

    Siblings in ascending order of capacity/weight fill up one after another as long as an even share of the rest
    exceeds their capacity; those after them get that share.
    """
    live = nodes.where("weight > 0 and capacity > 0")
    order = Window.partitionBy(*parents).orderBy(F.col("capacity") / F.col("weight"), *[x for x in LEVELS if x in nodes.columns])
    level = Window.partitionBy(*parents)
    placed = live.withColumn("_full", F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))).withColumn(
        "_rest", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    )
    placed = placed.withColumn("_share", (F.col("parent_budget") - F.col("_full")) / F.col("_rest"))
    full = F.col("_share") * F.col("weight") >= F.col("capacity")
    placed = placed.withColumn("_at", F.min(F.when(~full, F.struct(F.col("capacity") / F.col("weight"), "_share"))).over(level)["_share"])
    return placed.withColumn("budget", F.when(full, F.col("capacity")).otherwise(F.col("_at") * F.col("weight"))).drop("_full", "_rest", "_share", "_at")


def _given(weights: DataFrame, k: int) -> DataFrame:
    """The weights of nodes of the first k levels; of repeated ones the least."""
    names = list(LEVELS[:k])
    return weights.where(" and ".join([f"{x} is not null" for x in names] + [f"{x} is null" for x in LEVELS[k:]])).groupBy(*names).agg(F.min("weight").alias("weight"))


def budgets(leaves: DataFrame, weights: DataFrame, share: float, max_epochs: int) -> DataFrame:
    """(domain, lang, source, tokens, budget) of those leaves(domain, lang, source, tokens) that no weight excludes.

    weights(domain, lang, source, weight): lang and source are null for a domain's weight, source for a language's.
    The whole budget is share of all tokens. A node can supply what the leaves below it can that no weight excludes.
    """
    nodes = leaves.withColumn("capacity", F.col("tokens") * F.lit(float(max_epochs)))
    above = nodes.agg((F.sum("tokens") * F.lit(share)).alias("parent_budget")).withColumn("_root", F.lit(1))
    parents: list[str] = ["_root"]
    for k in range(1, len(LEVELS) + 1):
        names = list(LEVELS[:k])
        nodes = nodes.join(_given(weights, k).where("weight <= 0"), names, "left_anti")
    for k, level in enumerate(LEVELS, 1):
        names = list(LEVELS[:k])
        summed = nodes.withColumn("_root", F.lit(1)).groupBy("_root", *names).agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens"))
        sized = summed.join(above, parents).join(_given(weights, k), names, "left").withColumn("weight", F.coalesce(F.col("weight").cast("double"), F.lit(1.0)))
        done = _shared(sized, parents)
        parents = ["_root", *names]
        above = done.select(*parents, F.col("budget").alias("parent_budget"))
        if level == LEVELS[-1]:
            return done.select(*LEVELS, "tokens", "budget")
    raise AssertionError


def mix_sources(
    docs: DataFrame,
    weights: DataFrame,
    *,
    domain: Column,
    share: float = 0.6,
    max_epochs: int = 4,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokens_col: str | None = None,
) -> DataFrame:
    """The rows of docs that are taken, with domain, n_tokens and n_epochs, how often each is taken (at least once).

    tokens_col: a column that holds the number of tokens already; else the words of text_col are counted, once for the plan and
    once where the rows that are taken are read.
    """
    own = [c for c in docs.columns if c.lower() not in ("domain", "n_tokens", "n_epochs")]
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    counted = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(f"[^{SPACE}]+")) if tokens_col is None else F.coalesce(F.col(tokens_col), F.lit(0))
    leaf = F.struct(F.coalesce(domain.cast("string"), F.lit("")).alias("domain"), named("lang").alias("lang"), named("source").alias("source"))
    # All that is internal stands in one struct, so no name of the input can clash.
    inner = F.struct(leaf.alias("leaf"), F.col(id_col).cast("string").alias("id"), counted.cast("long").alias("n_tokens"), F.pmod(F.xxhash64(F.col(id_col)), F.lit(SALTS)).cast("int").alias("salt"))
    slim = cut(docs.select(inner.alias("x")).select("x.*").where("n_tokens > 0")).select("leaf.*", "id", "n_tokens", "salt")
    leaves = slim.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    # One row a leaf: whole epochs, the tokens left for one more, and its number for the order's seed.
    plan = budgets(leaves, weights, share, max_epochs).select(
        *LEVELS, F.floor(F.col("budget") / F.col("tokens")).alias("whole"), (F.floor("budget") - F.floor(F.col("budget") / F.col("tokens")) * F.col("tokens")).alias("rest")
    )
    plan = cut(plan.where("whole > 0 or rest > 0"))
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("whole").cast("string"), F.col("id")).cast("binary"))
    placed = slim.join(_dealt(plan), [*LEVELS, "salt"]).withColumn("order", order).withColumn("bucket", F.substring("order", 1, 3))
    sums = placed.groupBy(*LEVELS, "bucket", "rest").agg(F.sum("n_tokens").alias("tokens"))
    running = Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ends = sums.withColumn("upto", F.sum("tokens").over(running)).where("upto > rest")
    ends = ends.groupBy(*LEVELS).agg(F.min(F.struct("bucket", (F.col("upto") - F.col("tokens")).alias("before"))).alias("end"))
    last = cut(plan.join(ends, list(LEVELS), "left").select(*LEVELS, "whole", "rest", F.col("end.bucket").alias("end"), F.col("end.before").alias("before")))
    # The rows of the bucket in which a leaf's prefix ends, one by one.
    edge = placed.drop("rest").join(_dealt(last.select(*LEVELS, "rest", "end", "before")), [*LEVELS, "salt"]).where("bucket = end")
    edge = edge.groupBy(*LEVELS, "order", "id", "rest", "before").agg(F.sum("n_tokens").alias("tokens"))
    within = Window.partitionBy(*LEVELS).orderBy("order").rowsBetween(Window.unboundedPreceding, 0)
    edge = edge.withColumn("upto", F.col("before") + F.sum("tokens").over(within)).where("upto <= rest").select(*LEVELS, "id")
    # Rows and decisions meet as structs x, c and e.
    found = docs.select(F.struct(*own).alias("row"), inner.alias("x")).where("x.n_tokens > 0")
    found = found.join(_dealt(last).select(F.struct("*").alias("c")), F.expr(" and ".join([*[f"x.leaf.{k} = c.{k}" for k in LEVELS], "x.salt = c.salt"])))
    found = found.withColumn("at", F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("c.whole").cast("string"), F.col("x.id")).cast("binary")), 1, 3))
    same = [f"x.leaf.{k} = e.{k}" for k in LEVELS]
    found = found.join(edge.select(F.struct("*").alias("e")), F.expr(" and ".join(["at <=> c.end", *same, "x.id <=> e.id"])), "left")
    more = F.coalesce(F.col("at") < F.col("c.end"), F.lit(False)) | F.col("e").isNotNull()
    epochs = (F.col("c.whole") + F.when(more, 1).otherwise(0)).cast("long")
    taken = found.select("row", "x", epochs.alias("epochs")).where("epochs > 0")
    return taken.select(*[F.col("row")[c].alias(c) for c in own], F.col("x.leaf.domain").alias("domain"), F.col("x.n_tokens").alias("n_tokens"), F.col("epochs").alias("n_epochs"))


def _dealt(plan: DataFrame) -> DataFrame:
    """One row a leaf in SALTS copies: the rows of a leaf meet them in as many parts, so none is read by one task whole."""
    return plan.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
