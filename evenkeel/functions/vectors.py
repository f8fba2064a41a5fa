"""Sparse vectors put together and taken apart inside Spark, without Python."""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VECTOR = T.StructType([T.StructField("v", VectorUDT())])
_PARTS = "v struct<type: tinyint, size: int, indices: array<int>, values: array<double>>"


def unit_vector(index: Column, size: int) -> Column:
    """A sparse vector of ``size`` with a 1 at ``index``; all zero for null."""
    place = F.coalesce(index.cast("string"), F.lit(""))
    value = F.when(index.isNull(), "").otherwise("1.0")
    text = F.concat(
        F.lit(f'{{"v":{{"type":0,"size":{max(size, 1)},"indices":['), place, F.lit('],"values":['), value, F.lit("]}}"))
    return F.from_json(text, _VECTOR)["v"]


def vector_parts(vector: Column) -> Column:
    """type (0: sparse, 1: dense), size, indices and values of a vector."""
    return F.from_json(F.to_json(F.struct(vector.alias("v"))), _PARTS)["v"]


def folded_vector(parts: Column, width: int) -> Column:
    """A vector, given by its parts, in a hashed space of ``width``: entries of
    indices with one hash are added up."""
    indices = F.when(parts["type"] == 0, parts["indices"]).otherwise(
        F.sequence(F.lit(0), F.greatest(F.size(parts["values"]) - 1, F.lit(0))))
    slots = F.transform(indices, lambda i: F.pmod(F.xxhash64(i), F.lit(width)))
    cells = F.filter(F.arrays_zip(slots.alias("slot"), parts["values"].alias("x")), lambda c: c["x"] != 0)
    taken = F.array_sort(F.array_distinct(F.transform(cells, lambda c: c["slot"])))
    sums = F.transform(taken, lambda s: F.aggregate(
        F.filter(cells, lambda c: c["slot"] == s), F.lit(0.0), lambda total, c: total + c["x"]))
    vector = F.struct(F.lit(0).alias("type"), F.lit(width).alias("size"), taken.alias("indices"), sums.alias("values"))
    return F.from_json(F.to_json(F.struct(vector.alias("v"))), _VECTOR)["v"]


def sized(size: int) -> dict:
    """Metadata that tells estimators the size of a vector column."""
    return {"ml_attr": {"num_attrs": max(size, 1)}}
