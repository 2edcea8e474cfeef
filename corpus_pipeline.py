"""The corpus pipeline: quality rules, near-duplicates, repeated substrings, benchmark leaks, target mix.

Each stage takes (spark, docs, sf_dir) and returns the documents that it keeps; all but the last return the columns of
documents. Texts change where a stage cleans them, and n_chars follows.

Defined results, for every stage and for run(). An empty table gives an empty one. Null and empty texts count as without words: the
quality stage rejects them and the mix takes none; the stages between, called alone, keep them, copies of each other once. Null and repeated ids are
rows of their own, null ids come last where an order decides. Texts of any length are read whole. Columns beyond those of documents are
dropped, whatever their names. A stage's result must be written before the next stage is called: a stage begins by removing the tables
that earlier stages left in the shared folder, but for those that its input reads.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import WRITTEN, cut, remove, table
from millrace.llm.decontaminate import drop_leaks
from millrace.llm.line_quality import passing
from millrace.llm.minhash import keep_similar
from millrace.llm.queries import mixed
from millrace.llm.recompress import dedup_substrings

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Folders that stages wrote and that may go when the next one begins.
_LEFT: list[str] = []


def _stage(work: Stage) -> Stage:
    """A stage that removes what earlier ones left, so the disk holds the tables of one stage at a time."""

    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = {f"/{f.rsplit('/', 2)[1]}" for f in docs.inputFiles()} if _LEFT else set()
        gone = [x for x in _LEFT if x[x.rindex("/") :] not in read]
        remove(spark, gone)
        _LEFT[:] = [x for x in _LEFT if x not in gone]
        mark = len(WRITTEN)
        found = work(spark, docs, sf_dir)
        _LEFT.extend(WRITTEN[mark:])
        return found

    return run_stage


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, with the lines that failed removed. A text of a few words may be as good as any (of labelled texts under 50
    words 174 are good and 23 poor in the 0.1 tables, 937 and 38 in a larger one): length rejects none but those without words,
    repeats and failed lines do."""
    judged = passing(docs.select(*COLUMNS), min_words=1)
    cleaned = F.when(F.col("lost_chars") > 0, F.col("clean_text")).otherwise(F.col("text"))
    return judged.withColumn("text", cleaned).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by a similarity of 0.8 or more of 5-word shingles."""
    return keep_similar(docs.select(*COLUMNS), size=5, similarity=0.8)


@_stage
def repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of passages that start earlier; a document without any word left goes.

    A row's other columns, and its own text for rows that lose nothing, stay beside its result. Null ids come last, each by itself.
    """
    ordered = docs.select(*COLUMNS).withColumn("_order", F.coalesce("doc_id", F.lit(1 << 62) + F.monotonically_increasing_id()))
    others = [c for c in COLUMNS if c != "text"]
    found = dedup_substrings(ordered, "_order", with_text=True, rest=F.to_json(F.struct(*others, F.col("text").isNull().alias("_null"))))
    kind = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in others)
    found = found.withColumn("_own", F.from_json("rest", f"{kind}, _null boolean")).where("n_removed = 0 or n_removed < n_words")
    found = found.select(F.when(~F.col("_own._null"), F.col("text")).alias("text"), *[F.col(f"_own.{c}").alias(c) for c in others])
    return found.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


@_stage
def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no stretch of a benchmark item."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


@_stage
def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents taken for the target mix, with their domain, tokens and epochs."""
    return mixed(spark, docs.select(*COLUMNS))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_substrings", repeated_substrings),
    ("benchmark_leaks", benchmark_leaks),
    ("target_mix", target_mix),
]

#: MinHash keys by XXH64 and spaced seeds have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
        _LEFT.append(WRITTEN[-1])
    return STAGES[-1][1](spark, docs, sf_dir)
