"""Added spans of personal data: planted looser forms, clean texts, plain rules of choice."""

import random

import pytest
from pyspark.sql import functions as F

from evenkeel.llm import pii
from evenkeel.llm.pii import BASE, FORMS, KINDS, Judge, fit_judge, redacted, with_candidates, with_spans

WORDS = "the report of last year shows that prices went up in most regions while trade fell at home and abroad".split()


def luhn(rng):
    digits = [rng.randrange(10) for _ in range(15)]
    total = sum(d if i % 2 else 2 * d - 9 * (d > 4) for i, d in enumerate(digits))
    return "".join(map(str, [*digits, -total % 10]))


def iban(rng):
    bban = "".join(rng.choices("0123456789", k=18))
    return f"DE{98 - int(bban + '131400') % 97:02d}{bban}"


def person(rng, kind):
    """A base span."""
    if kind == "email":
        return f"{''.join(rng.choices('abcdefgh', k=6))}.{rng.randrange(99)}@{''.join(rng.choices('mnopq', k=5))}.example.org"
    if kind == "ip":
        return ".".join(str(rng.randrange(256)) for _ in range(4))
    if kind == "card":
        return luhn(rng)
    return f"+{rng.randrange(1, 99)} {rng.randrange(100, 999)} {rng.randrange(100, 999)} {rng.randrange(1000, 9999)}"


def looser(rng, form):
    mail, card = person(rng, "email"), luhn(rng)
    return {
        "brackets": mail.replace("@", " (at) ").replace(".", " (dot) "), "spaced": mail.replace("@", " @ "),
        "words": mail.replace("@", " at ").replace(".", " dot "), "defanged": person(rng, "ip").replace(".", "[.]"),
        "glued": "+1 (938) 555-122600041.2.3.4", "grouped": ".".join(card[i:i + 4] for i in range(0, 16, 4)),
        "national": person(rng, "phone").split(" ", 1)[1], "long": "2001:db8:" + ":".join(f"{rng.randrange(1 << 16):04x}" for _ in range(6)),
        "iban": iban(rng), "key": "AKIA" + "".join(rng.choices("ABCDEFGH234567", k=16)), "assigned": "password = hunter2hunter2",
    }[form]


PLANTED = ("brackets", "spaced", "words", "defanged", "glued", "grouped", "national", "long", "iban", "key", "assigned")


def sentence(rng, inner=""):
    words = rng.choices(WORDS, k=rng.randrange(8, 30))
    if inner:
        words.insert(rng.randrange(2, len(words)), inner)
    return " ".join(words) + "."


@pytest.fixture(scope="module")
def fitted(spark):
    rng = random.Random(5)
    texts = [sentence(rng, person(rng, list(BASE)[i % 4])) for i in range(400)]
    texts += [sentence(rng, rng.choice(["2024-03-01", "12,500", "10:30", "in 1998", "3.14", "", ""])) for _ in range(600)]
    corpus = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    return fit_judge(corpus)


def test_planted_forms_are_found_and_clean_texts_left_alone(spark, fitted):
    rng = random.Random(6)
    rows = [(i, form, sentence(rng, looser(rng, form))) for i, form in enumerate(PLANTED * 30)]
    rows += [(1000 + i, None, sentence(rng, rng.choice(["2021-11-30", "7,200", "at 9:15", "2.71", ""]))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, form string, text string").repartition(4)
    got = with_spans(docs, fitted, carry=("doc_id", "form", "text")).withColumn("clean", redacted(F.col("text"), F.col("spans"))).collect()
    found = {form: [len(r.spans) > 0 for r in got if r.form == form] for form in PLANTED}
    share = {form: sum(x) / len(x) for form, x in found.items()}
    assert min(share.values()) >= 0.9, share
    clean = [r for r in got if r.form is None]
    assert sum(not r.spans for r in clean) >= 0.99 * len(clean)
    for r in got:
        for s in r.spans:
            assert not s.base and r.clean.count(f"[{KINDS[s.kind].upper()}]") >= 1
    assert all("41.2.3.4" not in r.clean for r in got if r.form == "glued")


def test_added_spans_by_hand(spark):
    """With a judge that takes all, added spans are chosen from left to right and touch nothing."""
    rng = random.Random(8)
    parts = [person(rng, k) for k in BASE] + [looser(rng, f) for f in PLANTED] + [" ", " ", "x", "at", "12", "-", "é", "🙂", "\n"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(20))) for _ in range(200)]
    texts += [None, "", "12 34 " * 8000, "a (at) b (dot) c " * 3000, "AAAA:" * 20000, "1.2.3." * 20000, "token=" * 9000, "DE44" * 9000, "a @ " * 9000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").select("*", F.lit(1).alias("FOUND")).repartition(4)
    every = Judge((), (0.0,) * (len(BASE) + len(FORMS)))
    candidates = {r.doc_id: r.found for r in with_candidates(docs.select("doc_id", "text")).collect()}
    for r in with_spans(docs, every, carry=("doc_id", "text")).collect():
        found, want = candidates[r.doc_id], []
        for c in found:
            assert (r.text or "")[c.start:c.end] == c.body
            left, right = r.text[max(0, c.start - 24):c.start], r.text[c.end:c.end + 12]
            assert left.endswith(c.before) and right.startswith(c.after)
        base = [c for c in found if c.base]
        if len(found) < 3000:
            for c in sorted((c for c in found if not c.base), key=lambda c: (c.start, -c.end, c.kind)):
                if all(c.end <= b.start or b.end <= c.start for b in base + want):
                    want.append(c)
            assert [tuple(s) for s in r.spans] == sorted((c.kind, c.start, c.end, c.base) for c in base + want)


def test_all_candidates_are_learned_from(spark, monkeypatch):
    tables, write = {}, pii.materialize
    monkeypatch.setattr(pii, "materialize", lambda df, name: tables.setdefault(name, write(df, name)))
    docs = spark.range(120).selectExpr("concat('write to u', id, '@example.org, not 300.1.1.', id, ' but 10.0.0.', id) AS text")
    assert fit_judge(docs, 5) is not None
    own = {(r["generator"], r["label"]): r["count"] for r in tables["judged"].groupBy("generator", "label").count().collect()}
    assert own[0, True] >= 120 and own[1, True] >= 120 and own[1, False] >= 120
    seen = tables["examples"].groupBy("gen", "label").agg({"*": "count", "weight": "sum"}).collect()
    assert {(r["gen"], r["label"] == 1): r["count(1)"] for r in seen} == own
    assert all(abs(r["sum(weight)"] - min(5, r["count(1)"])) < 1e-6 for r in seen)
