"""From raw documents to token ids, in five stages.

Each stage reads what the one before kept. All but the last return the columns of
documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.llm.bpe import encode, read_ranks
from evenkeel.llm.decontaminate import decontaminate
from evenkeel.llm.jaccard import jaccard_join
from evenkeel.llm.language import fit_language, identify, training_rows
from evenkeel.llm.pii import fit_judge, redacted, with_spans
from evenkeel.llm.queries import VOCABULARY
from evenkeel.llm.texts import Marks, pick
from evenkeel.sources.shared import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in no known language."""
    judged = identify(docs, fit_language(training_rows(docs)), carry=COLUMNS)
    return judged.where(~F.col("rejected")).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near copies, that of the smallest id (a
    null id is never the smallest). Rows without words link with nothing and
    all stay.

    Rows are told apart by a hash of all columns, not by their id: ids may
    repeat or be null. Of rows that share the smallest id of a group, that of
    the smallest hash stays; of equal rows, one.
    """
    known = [F.col(c).isNotNull() for c in COLUMNS]  # the hash skips nulls
    rows = pick(docs, *COLUMNS).withColumn("row", F.xxhash64(*COLUMNS, *known))
    worded = F.coalesce(F.col("text").rlike(r"[^\t\n\x0B\f\r\x20]"), F.lit(False))
    full = rows.where(worded)
    groups = jaccard_join(full.select(F.col("row").alias("doc_id"), "text"))
    parts = groups.groupBy(F.col("doc_id").alias("row")).agg(F.min("component_id").alias("part"))
    ids = full.groupBy("row").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "n"))
    placed = materialize(ids.join(parts, "row"), "placed")
    kept = materialize(placed.groupBy("part").agg(first.alias("r")).select("r.row", "r.n"), "kept")
    # few rows are dropped or repeated: texts of others stay where they lie. Rows that hit
    # the marks of those by chance are looked up among the kept ones that do
    aside = placed.select("row").join(kept.where("n = 1"), "row", "left_anti")
    marks = Marks(materialize(aside, "aside"), "row")
    sure = F.col("empty") | ~marks.hits("row")
    told = rows.withColumn("empty", ~worded)
    one = told.where(sure).select(*COLUMNS)
    kept = materialize(kept.where(marks.hits("row")), "kept")
    doubtful = told.where(~sure)
    one = one.unionByName(doubtful.join(kept.where("n = 1").select("row"), "row", "left_semi").select(*COLUMNS))
    repeated = kept.where("n > 1").select("row")
    if not repeated.isEmpty():
        again = doubtful.join(repeated, "row", "left_semi")
        least = again.groupBy("row").agg(F.min(F.struct(*COLUMNS)).alias("r")).select("r.*")
        one = one.unionByName(least)
    return one


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold benchmark passages."""
    judged = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), carry=COLUMNS)
    return judged.where(~F.col("contaminated")).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind."""
    rows = with_spans(docs, fit_judge(docs), carry=COLUMNS)
    clean = F.when(F.size("spans") > 0, redacted(F.col("text"), F.col("spans"))).otherwise(F.col("text"))
    changed = F.when(F.size("spans") > 0, F.length(clean).cast("long")).otherwise(F.col("n_chars"))
    return rows.select("doc_id", clean.alias("text"), "lang", "source", changed.alias("n_chars"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids: doc_id, lang, source, n_tokens, ids."""
    ranks = read_ranks(public_tokenizers.path(VOCABULARY))
    return encode(docs, ranks, public_tokenizers.PATTERN, carry=("doc_id", "lang", "source"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language), ("near copies", near_copies), ("benchmarks", benchmarks),
    ("personal data", personal_data), ("tokens", tokens),
]

#: A language model and boosted trees decide stages; SQL cannot say that.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
SQL = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
