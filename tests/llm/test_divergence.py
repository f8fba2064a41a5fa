"""The divergence audit against exact whole numbers, group by group."""

import collections
import random
import re

import numpy as np
import pytest

from evenkeel.llm import divergence
from evenkeel.llm.divergence import divergence_audit, gallop, gaps, rates

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PATTERN = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"


def by_hand(rows, least, top):
    counts, held, groups = collections.Counter(), collections.Counter(), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = re.findall(PATTERN, (text or "").translate(LOW))
        counts.update((lang, source, w) for w in words)
        held.update((lang, w) for w in set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [w for (g, w), n in held.items() if g == lang and n >= least]
        sources = sorted(s for g, s in groups if g == lang)
        n = {(s, w): counts[lang, s, w] for s in sources for w in kept}

        def priced(count):
            whole = sum(count.values()) + 2 * len(kept)
            return {w: 1 + 10**9 * (c + 2) // whole for w, c in count.items()}

        def gap(p, q):
            return (p - q) ** 2 // (p + q)

        p = {s: priced({w: n[s, w] for w in kept}) for s in sources}
        q = priced({w: sum(n[s, w] for s in sources) for w in kept})
        for s in sources:
            pairs = [(x, sum(gap(p[s][w], p[x][w]) for w in kept)) for x in sources if x != s]
            terms = [(w, gap(p[s][w], q[w])) for w in kept if n[s, w] > 0 and p[s][w] > q[w]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda i: (-i[1], i[0].encode()))
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(items[:most], 1)]
    return out


@pytest.mark.parametrize("slice_terms, block, held", [(1 << 14, 32, 400_000), (7, 2, 50)])
def test_divergence(spark, monkeypatch, slice_terms, block, held):
    monkeypatch.setattr(divergence, "HELD", held)
    monkeypatch.setattr(divergence, "PIECE", 64)
    rng = random.Random(5)
    words = ["Der", "die", "und", "été", "Straße", "x", "I", "naïve", "語", *[f"w{chr(97 + i)}" for i in range(20)]]
    rows = []
    for _ in range(220):
        lang, source = rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "é", None, "c", "d"])
        rows.append((lang, source, rng.choice([" ", "-", "0", "\n"]).join(rng.choices(words[: rng.randrange(3, 29)], k=rng.randrange(40)))))
    rows += [("xx", "only", "lonely words"), ("xx", "more", None), ("yy", "one", ""), ("en", "hot", "the " * 5000), rows[0], rows[0]]
    docs = spark.createDataFrame([(*r, 1, "clash") for r in rows], "lang string, source string, text string, n int, Text string")
    got = divergence_audit(docs.repartition(3), least_docs=4, top=3, slice_terms=slice_terms, block=block)
    assert sorted(map(tuple, got.collect())) == sorted(by_hand(rows, 4, 3))


def test_empty_table(spark):
    assert divergence_audit(spark.createDataFrame([], "lang string, source string, text string")).count() == 0


def test_gallop():
    rng = np.random.default_rng(1)
    for n, m in ((0, 5), (1, 1), (3, 4000), (500, 600), (4000, 4000)):
        a, b = (np.unique(rng.integers(0, 9000, k)) for k in (n, m))
        i, j = gallop(a, b)
        assert (a[i] == np.intersect1d(a, b)).all() and (b[j] == a[i]).all()


def test_rates_are_exact():
    whole = 8_999_999_999_999_999
    counts = [0, 1, 999, 123_456_789_012_345, whole - 3, whole - 2]
    assert rates(np.array(counts), whole).tolist() == [1 + 10**9 * (c + 2) // whole for c in counts]
    p, q = np.array([10**9 + 1, 5]), np.array([1, 5])
    assert gaps(p, q).tolist() == [(10**9) ** 2 // (10**9 + 2), 0]
