"""The Merkle manifest against one made by hand."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from evenkeel.llm import manifest
from evenkeel.llm.manifest import merkle_manifest

COLUMNS = "doc_id long, source string, lang string, n_chars long, text string, TEXT string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, added=0):
    doc_id, source, lang, n_chars, text = row[:5]
    values = [doc_id, source, lang, None if n_chars is None else n_chars + added, text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """The root, and for each node the list of (siblings before, siblings after)."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i: i + 2])) for i in range(0, len(last), 2)])
    ways = []
    for i in range(len(nodes)):
        way = []
        for level in levels[:-1]:
            run = level[i // 2 * 2: i // 2 * 2 + 2]
            way.append((run[: i % 2], run[i % 2 + 1:]))
            i //= 2
        ways.append(way)
    return levels[-1][0], ways


def by_hand(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    trees = {g: tree([leaf_of(r) for r in groups[g]]) for g in names}
    root, tops = tree([trees[g][0] for g in names])
    out = []
    for g, top in zip(names, tops):
        for r, way in zip(groups[g], trees[g][1]):
            whole = way + top
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            node = leaf_of(r, 1 if hit else 0)
            for before, after in whole:
                node = sha("".join([*before, node, *after]))
            proof = sha("".join(s for before, after in whole for s in (*before, *after)))
            out.append((r[0], leaf_of(r), trees[g][0], root, proof, node, node == root))
    return out


def check(spark, rows):
    docs = spark.createDataFrame([(*r, "clash") for r in rows], COLUMNS).repartition(3)
    got = merkle_manifest(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 0)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, by_hand(rows)))


def rows_of(ids, langs, seed=3):
    rng = random.Random(seed)
    return [(i, rng.choice(["a", None, "bé"]), rng.choice(langs), rng.choice([None, 0, 12]), rng.choice(["", None, f"t{i}", "🙂" * 9]))
            for i in ids]


def test_many_levels(spark, monkeypatch):
    """Small blocks, chunks and cells: several rounds, negative and far ids."""
    for name, value in (("LEVELS", 2), ("_SLOTS", 4), ("CHUNK", 3), ("FAN", 2), ("CELL_ROWS", 16), ("HELD", 20)):
        monkeypatch.setattr(manifest, name, value)
    ids = [*range(-40, 60, 3), *range(100, 171), 2**62, -(2**63), 2**63 - 1, 2**40 + 1, 2**40]
    check(spark, rows_of(ids, [None, "", "de", "en", "é", "z"]))


def test_repeated_ids_and_rows(spark):
    """Null ids, ids with different rows, equal rows and large ones."""
    rows = rows_of([5, 5, 5, None, None, None, 1, 2, 3, 4, 9, 9, 4100, 4101, 8200], ["en", "de"])
    rows += [(7, "s", "en", 1, "same")] * 40 + [(None, "s", "en", 1, "same")] * 3 + [(8, "s", "en", 1, "x" * 300_000)]
    check(spark, rows)


@pytest.mark.parametrize("langs", [["en"], [f"l{i:03}" for i in range(60)]])
def test_few_and_many_groups(spark, langs):
    check(spark, rows_of(range(70), langs))


def test_one_row_and_none(spark):
    check(spark, [(3, None, None, None, None)])
    empty = merkle_manifest(spark.createDataFrame([], COLUMNS))
    assert empty.count() == 0 and empty.columns[-1] == "verified"


def test_untampered_rows_verify(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert merkle_manifest(docs).where(~F.col("verified")).count() == 0
