"""Categories of any number of columns as one table.

The values of all columns are counted in one pass and put in order by a range
sort, so that a number is the offset of a partition plus a place in it; nothing
but the number of values per column and per partition reaches the driver. Rows
meet their numbers by joins: frequent values are broadcast, bounded in number
and length, all others go through a shuffle join in which rows that already have
their number are spread by hash.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions.columns import category_text, col, cols, dtype, is_number, keep_free, text
from evenkeel.functions.vectors import sized, unit_vector
from evenkeel.operators.validate import require_columns
from evenkeel.sources.shared import materialize, write_scratch

# Most values of a column that are broadcast, none of them longer than this.
BROADCAST_VALUES = 100_000
BROADCAST_BYTES = 256

_SCHEMA = "`column` string, value string, index bigint, n bigint"


@dataclass(frozen=True)
class CategoryDictionary:
    """Where the table (column, value, index, n) lies, and how many values
    each column has. Values are numbered from 0 in their order (numbers by
    value), a missing one last; ``n`` counts the rows with it."""

    path: str
    widths: dict[str, int] = field(default_factory=dict)

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(_SCHEMA).parquet(self.path)


def category_dictionary(df: DataFrame, columns: Sequence[str], path: str | None = None) -> CategoryDictionary:
    """Number the values of each column, in one pass over the table.

    Without a ``path`` the dictionary is written to the shared folder.
    """
    names = list(dict.fromkeys(columns))
    require_columns(df, names)
    spark = df.sparkSession
    if not names:
        empty = spark.createDataFrame([], _SCHEMA)
        return CategoryDictionary(write_scratch(empty, "categories"))
    cells = F.array(*[F.expr(f"struct({i} AS i, {category_text(df, c)} AS value)") for i, c in enumerate(names)])
    counts = df.select(F.inline(cells)).groupBy("i", "value").agg(F.count(F.lit(1)).alias("n"))
    numeric = [i for i, c in enumerate(names) if is_number(dtype(df, c))]
    number = F.when(F.col("i").isin(numeric), F.expr("try_cast(value AS double)"))
    ordered = counts.orderBy("i", F.col("value").isNull(), number, "value")
    placed = materialize(ordered.withColumn("spot", F.monotonically_increasing_id()), "sorted-values")
    part, row = F.shiftright("spot", 33), F.col("spot").bitwiseAND((1 << 33) - 1)
    # a row per partition of the sort
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    found = {r["i"]: r["count"] for r in placed.groupBy("i").count().collect()}
    widths, starts, start = {}, [], 0
    for i, c in enumerate(names):
        widths[c] = found.get(i, 0)
        starts.append(start)
        start += widths[c]
    first = F.element_at(F.array(*[F.lit(s).cast("bigint") for s in starts]), F.col("i") + 1)
    named = F.element_at(F.array(*[F.expr(text(c)) for c in names]), F.col("i") + 1)
    numbered = placed.withColumn("part", part).join(F.broadcast(offsets), "part").select(
        named.alias("column"), "value", (F.col("before") + row - first).alias("index"), "n")
    if path is None:
        path = write_scratch(numbered, "categories")
    else:
        numbered.write.mode("overwrite").parquet(path)
    return CategoryDictionary(path, widths)


def with_category_index(
    df: DataFrame, dictionary: CategoryDictionary, columns: Sequence[str] | None = None, suffix: str = "_index"
) -> DataFrame:
    """Add the number of each value as ``<column><suffix>``, null for values
    that the dictionary lacks."""
    names = list(dictionary.widths if columns is None else columns)
    require_columns(df, names)
    keep_free(df.columns, [f"{c}{suffix}" for c in names])
    table = dictionary.table(df.sparkSession)
    own = df.columns
    spread = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    for i, c in enumerate(names):
        mark, index = f"__mark{i}", f"__index{i}"
        # marked, so that a missing value and a value of any text differ
        marked = F.expr(f"coalesce(concat('=', {category_text(df, c)}), 'missing')")
        entry = F.coalesce(F.concat(F.lit("="), F.col("value")), F.lit("missing"))
        entries = table.filter(F.col("column") == c)
        short = entries.filter(F.coalesce(F.octet_length("value"), F.lit(0)) <= BROADCAST_BYTES)
        if dictionary.widths.get(c, 0) > BROADCAST_VALUES:
            short = short.orderBy(F.desc("n"), "index").limit(BROADCAST_VALUES)
        near = short.select(entry.alias(mark), F.col("index").alias(index))
        df = df.withColumn(mark, marked).join(F.broadcast(near), mark, "left")
        far = entries.filter(F.octet_length("value") > BROADCAST_BYTES)
        if dictionary.widths.get(c, 0) > BROADCAST_VALUES:
            far = entries
        elif far.isEmpty():
            df = df.drop(mark)
            continue
        far = far.select(entry.alias(mark), F.col("index").alias("__far"))
        settled = F.concat(F.lit("!"), F.xxhash64(*cols(spread)).cast("string"))
        df = df.withColumn(mark, F.when(F.col(index).isNull(), F.col(mark)).otherwise(settled))
        df = df.join(far, mark, "left").withColumn(index, F.coalesce(index, "__far")).drop(mark, "__far")
    return df.select(*cols(own), *[F.col(f"__index{i}").alias(f"{c}{suffix}") for i, c in enumerate(names)])


def with_category_vectors(
    df: DataFrame, dictionary: CategoryDictionary, columns: Sequence[str] | None = None, suffix: str = "_onehot"
) -> DataFrame:
    """Add a sparse 0/1 vector per column as ``<column><suffix>``; values that
    the dictionary lacks are all zero."""
    names = list(dictionary.widths if columns is None else columns)
    keep_free(df.columns, [f"{c}{suffix}" for c in names])
    indexed = with_category_index(df, dictionary, names, "__place")
    return indexed.select(*cols(df.columns), *[
        unit_vector(col(f"{c}__place"), dictionary.widths[c]).alias(f"{c}{suffix}", metadata=sized(dictionary.widths[c]))
        for c in names])


__all__ = ["CategoryDictionary", "category_dictionary", "with_category_index", "with_category_vectors"]
