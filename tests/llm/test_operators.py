"""Each operator against a brute-force version on small tables, and on rows
that are null, empty, long, tied, repeated or named alike."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from evenkeel.llm import suffix_tree
from evenkeel.llm.bpe import Encoder, PerfectHash, decode, encode, read_ranks
from evenkeel.llm.components import components
from evenkeel.llm.decontaminate import decontaminate
from evenkeel.llm.jaccard import jaccard_join
from evenkeel.llm.language import fit_language, identify
from evenkeel.llm.neighbours import nearest
from evenkeel.llm.pii import fit_judge, redacted, with_spans
from evenkeel.llm.queries import HOST_RULES, PATTERN_RULES, VOCABULARY, with_edits
from evenkeel.llm.suffix_tree import score_texts, training_condition
from evenkeel.llm.token_counts import TokenTree, edited_counts
from evenkeel.llm.toxicity import fit_toxicity, score_toxicity, training_sample
from evenkeel.llm.url_rules import judge

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture
def rng():
    return random.Random(11)


@pytest.fixture(scope="module")
def texts():
    """Sentences of few words, near copies of some, and odd ones."""
    rng = random.Random(11)
    names = [f"w{i}" for i in range(300)]
    base = [[rng.choice(names) for _ in range(rng.choice([5, 30, 80]))] for _ in range(40)]
    out = [" ".join(w) for w in base]
    for w in base[:12]:
        for _ in range(3):
            c = list(w)
            c[rng.randrange(len(c))] = "Other"
            out.append("\t".join(c))
    out += [None, "", "   ", "one", "ONE", "one two three", "é Ünï 🙂 x y", "lang " * 3000, out[0], out[0].upper()]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    """Ids are not in order, one is null; another column differs only in case."""
    rows = [(None if i == 7 else (i * 37) % 1009, t, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, TEXT string").repartition(3)


@pytest.fixture(scope="module")
def ranks():
    return read_ranks(public_tokenizers.path(VOCABULARY))


def words_of(text, pattern):
    return re.findall(pattern, (text or "").translate(LOW))


def test_components(spark, rng):
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(5, 5), (1, 2), (1, 2)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    least = list(range(200))
    for _ in range(200):
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    assert found == {n: least[n] for n in found}
    assert set(found) == {n for a, b in links if a != b for n in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("frequent", [1, 8])
def test_jaccard(docs, frequent):
    rows = docs.toDF("doc_id", "text", "c").collect()
    sets = []
    for r in rows:
        w = words_of(r.text, "[^\x20\x09-\x0d]+")
        k = min(4, len(w))
        sets.append({tuple(w[i: i + k]) for i in range(len(w) - k + 1)} if w else set())
    near = collections.defaultdict(set)
    for i, j in itertools.combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if common and 100 * common >= 85 * len(sets[i] | sets[j]):
            near[i].add(j)
            near[j].add(i)
    want = []
    for i, r in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            todo += [j for j in near[todo.pop()] if j not in seen and not seen.add(j)]
        ids = [rows[j].doc_id for j in seen if rows[j].doc_id is not None]
        want.append((r.doc_id, len(sets[i]), min(ids) if ids else None, len(near[i])))
    got = [tuple(r) for r in jaccard_join(docs, frequent=frequent).drop("class_id").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert jaccard_join(docs.limit(0)).count() == 0


@pytest.mark.parametrize("item_chars", [10**6, 200])
def test_decontamination(spark, docs, texts, item_chars):
    pieces = [(1, " ".join(texts[1].split()[:20])), (2, "one"), (2, "two three"), (10, texts[0]), (3, None), (4, "?!"),
              (None, "é Ünï")]
    bench = spark.createDataFrame(pieces, "item_id long, text string")
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    want = []
    for r in docs.toDF("doc_id", "text", "c").collect():
        w = words_of(r.text, pattern)
        hit, items = set(), set()
        for name, text in pieces:
            x = words_of(text, pattern)
            k = min(13, len(x))
            for p, q in itertools.product(range(len(w) - k + 1), range(len(x) - k + 1)) if k else ():
                if w[p: p + k] == x[q: q + k]:
                    hit |= set(range(p, p + k))
                    items.add(str(name))
        want.append((r.doc_id, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(),
                     len(hit) > 0 and 20 * len(hit) >= len(w)))
    got = [tuple(r) for r in decontaminate(docs, bench, item_chars=item_chars).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert not decontaminate(docs, bench.limit(0)).where("contaminated").count()
    with pytest.raises(ValueError):
        decontaminate(docs.withColumn("n_hit", F.lit(1)), bench, carry=("n_hit",))


def test_bpe_is_that_of_tiktoken(spark, docs, ranks, rng):
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = encode(docs, ranks, public_tokenizers.PATTERN, carry=("text",))
    for r in rows.collect():
        assert r.ids == known.encode_ordinary(r.text or "") and r.n_tokens == len(r.ids)
    back = decode(rows, ranks, carry=("text",)).collect()
    assert all(bytes(r.decoded).decode() == (r.text or "") for r in back)
    coder = Encoder(ranks, public_tokenizers.PATTERN)
    odd = list("ab c'slltre \n\t\r\x1c\x85\xa0 　é9²Ⅷ日本🙂👩‍👧.,_-'́’\x00") + ["'ll", "  ", " 123"]
    for _ in range(2000):
        t = "".join(rng.choices(odd, k=rng.randrange(30)))
        assert np.frombuffer(coder.encode(t), "<u4").tolist() == known.encode_ordinary(t)


def test_perfect_hash_is_minimal():
    entries = {str(i).encode(): i * 3 for i in range(5000)}
    table = PerfectHash(entries)
    assert len(table.keys) == len(entries) and None not in table.keys
    assert all(table.get(k) == v for k, v in entries.items()) and table.get(b"x") is None
    assert PerfectHash({}).get(b"") is None


def test_token_counts_follow_edits(docs, texts, ranks, rng):
    coder = Encoder(ranks, public_tokenizers.PATTERN)

    def count(t):
        return sum(len(coder[p]) // 4 for p in coder.pattern.findall(t))

    odd = list("ab c'slltre \n\t é9日🙂.,_-'") + ["'ll", "   ", "the"]
    for k in range(150):
        t = "".join(rng.choices(odd, k=rng.randrange(600)))
        tree = TokenTree(t, coder)
        for _ in range(6):
            at, cut, new = rng.randrange(len(t) + 3), rng.choice([0, 1, 5, 300]), "".join(rng.choices(odd, k=rng.choice([0, 1, 90])))
            tree.edit(at, cut, new)
            at = min(at, len(t))
            t = t[:at] + new + t[at + cut:]
            assert tree.text == t and tree.tokens == count(t)
    rows = with_edits(docs.toDF("doc_id", "text", "c").drop("c"))
    for r in edited_counts(rows, ranks, public_tokenizers.PATTERN, carry=("text", "edits")).collect():
        t = r.text or ""
        assert r.n_tokens == count(t)
        for e in r.edits or ():
            at = min(e["at"] or 0, len(t))
            t = t[:at] + (e["insert"] or "") + t[at + (e["remove"] or 0):]
        assert r.n_edited == count(t)
    long = TokenTree(texts[-3], coder)
    long.encoded = 0
    long.edit(7000, 3, "abc")
    assert long.encoded < 20


def test_nearest(spark, rng):
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, 2.0]) for _ in range(8)]) for i in range(300)]
    rows += [(300, None), (301, [0.0] * 8), (302, [float("nan")] * 8), (303, [1.0, None] * 4), (304, [1.0, 2.0]), (None, [1.0] * 8),
             (305, [1e200] * 8), (306, [1e-200] * 8), (10, rows[20][1]), (307, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    ok = [(i, np.array(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    first = {}
    for i, v in ok:
        first[i] = min(first[i], tuple(v)) if i in first else tuple(v)
    want = []
    for q in [0, 10, 20, 304, 305]:
        a = np.array(first[q])
        found = sorted((-float((x @ y) / (np.linalg.norm(x) * np.linalg.norm(y))), i) for i, v in ok if i != q and len(v) == len(a)
                       for x, y in [(a / abs(a).max(), v / abs(v).max())])
        want += [(q, k, round(-s, 9)) for k, (s, _) in enumerate(found[:5], 1)]
    got = nearest(table, table.where("vec_id IN (0, 10, 20, 300, 301, 304, 305)")).collect()
    assert sorted((r.query_id, r["rank"], round(r.score, 9)) for r in got) == sorted(want)
    assert all(a.vec_id < b.vec_id for a, b in itertools.pairwise(sorted(got, key=lambda r: (r.query_id, r["rank"])))
               if a.query_id == b.query_id and a.score == b.score)
    assert nearest(table, table.limit(0)).count() == 0


def test_scores_and_known_words(docs):
    got = score_texts(docs, training_condition(7, 2)).collect()
    rows = docs.toDF("doc_id", "text", "c").collect()

    def out(i):
        return zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2

    tokens = [words_of(r.text, "[^\x20\x09-\x0d]+") + [" "] for r in rows]
    c = collections.Counter(w for r, t in zip(rows, tokens) if not out(r.doc_id) for w in t)
    n, v = sum(c.values()), len(c)
    want = sorted((str(r.doc_id), out(r.doc_id), len(t), sum(c[w] > 0 for w in t), n,
                   round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), 6)) for r, t in zip(rows, tokens))
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)
    assert score_texts(docs.limit(0), "true").count() == 0
    nothing = score_texts(docs, "false").collect()
    assert all(r.n_known == 0 and r.base_score == 0 for r in nothing)


def test_languages(spark):
    rng = random.Random(4)
    tongues = {"aa": "ba ka la ma na".split(), "bb": "ith oth eth uth ang".split()}

    def text(lang, n):
        return " ".join("".join(rng.choices(tongues[lang], k=3)) for _ in range(n))

    rows = [(i, text(lang, 40), lang) for i, lang in enumerate(["aa", "bb"] * 60)] + [(900, None, "aa"), (901, "123", "bb"), (902, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit_language(docs)
    asked = [(1, text("aa", 9)), (2, text("bb", 9)), (3, None), (4, ""), (5, "12 !"), (6, "Ж" * 500), (7, text("aa", 20000))]
    got = {r.doc_id: r for r in identify(spark.createDataFrame(asked, "doc_id long, text string"), model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 4, 5, 7)] == ["aa", "bb", "und", "und", "und", "aa"]
    assert [got[i].rejected for i in range(1, 8)] == [False, False, True, True, True, True, False]
    assert all(0 <= r.score <= 1 for r in got.values())
    none = identify(docs, fit_language(docs.limit(0))).collect()
    assert {r.lang_pred for r in none} == {"und"}


def test_copies_do_not_fill_the_language_sample(spark):
    rng = random.Random(6)
    tongues = {"aa": "ba ka la ma na".split(), "bb": "ith oth eth uth ang".split()}
    rows = [(" ".join("".join(rng.choices(tongues[lang], k=3)) for _ in range(30)), lang) for lang in ["aa", "bb"] * 40]
    docs = spark.createDataFrame(rows, "text string, lang string")
    copies = spark.createDataFrame([("baka", "aa")], "text string, lang string").join(spark.range(3000)).drop("id")
    one, many = (fit_language(d, sample=20) for d in (docs.unionByName(copies.limit(1)), docs.unionByName(copies)))
    assert [k.tolist() for k in one.keys] == [k.tolist() for k in many.keys]
    assert all(np.array_equal(a, b) for a, b in zip(one.rows, many.rows))
    asked = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r for r in identify(asked, many).collect()}
    assert all(got[i].lang_pred == lang and not got[i].rejected for i, (_, lang) in enumerate(rows))


def test_toxicity(spark):
    rng = random.Random(5)
    plain = "the river runs slowly past quiet houses and green fields".split()
    rows = []
    for i in range(400):
        w = rng.choices(plain, k=30)
        if i % 5 == 0:
            w[3] = "scoundrel"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows + [(1000, None), (1001, ""), (1002, "Scoundrel " + "the " * 20000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(300)] + [(1, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    weights, intercept = fit_toxicity(training_sample(docs, labels))
    got = {r.doc_id: r for r in score_toxicity(docs, weights, intercept).collect()}
    assert all(got[i].predicted == int(i % 5 == 0) for i in range(400))
    assert got[1000].predicted == got[1001].predicted == 0 and got[1002].predicted == 1
    weights, intercept = fit_toxicity(training_sample(docs, labels.limit(0)))
    assert score_toxicity(docs.limit(0), weights, intercept).count() == 0


def test_toxic_stems(spark):
    """Insults are compounds on one stem, each of them rare; clean words share shorter parts."""
    rng = random.Random(6)
    ends = ["".join(rng.choices("aeioulnrst", k=4)) for _ in range(300)]
    plain = [a + b for a in ("grimm", "immel", "rimmt", "melka", "tagri") for b in ends[:60]]
    rows = []
    for i in range(2000):
        w = rng.choices(plain, k=40)
        if i % 8 == 0:
            w[7] = "grimmel" + ends[rng.randrange(300)]
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 8 == 0)) for i in range(2000)], "doc_id long, toxic int")
    weights, intercept = fit_toxicity(training_sample(docs, labels))
    got = {r.doc_id: r.predicted for r in score_toxicity(docs, weights, intercept).collect()}
    held = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 5 == 0]
    found = [got[i] for i in held if i % 8 == 0]
    assert sum(found) >= 0.75 * len(found) > 0 and not any(got[i] for i in held if i % 8)


def test_languages_of_one_text(spark):
    rows = [(f"l{i}", chr(0x4E00 + 50 * i) * 3 + f" {'bcdfghjklmnp'[i]}a" * 20) for i in range(12)]
    model = fit_language(spark.createDataFrame(rows, "lang string, text string"))
    assert sorted(model.names) == sorted(name for name, _ in rows)


URLS = [
    (1, "https://A.example.NET/en/x"), (2, "http://b.net"), (3, "http://b.net?q=/"), (4, "http://x.example.com/de/1#top"),
    (5, "http://q.org/fr/"), (6, None), (7, ""), (8, "no scheme"), (9, "http://www.cheap-pills.info/"), (10, "http://casino-x.org/fr/"),
    (11, "http://mynet/"), (12, "http://net/"), (13, "://net/a"), (14, "http://a.com/?u=http://b.net/"), (15, "http://example.net/en"),
    (1, "https://A.example.NET/en/x"), (16, "http://a.com/" + "net/" * 20000), (17, "http://casino-x.com/robots.txt"),
]


def test_url_rules(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string").select("*", F.lit("http://c.net/").alias("URL"))
    got = sorted(tuple(r) for r in judge(pages, HOST_RULES, PATTERN_RULES).select("page_id", "rule", "verdict").fillna("").collect())
    want = {1: ("example.net/en/", "allow"), 4: ("example.com/de/", "block"), 5: ("org/fr/", "allow"), 9: ("", "block"),
            10: ("org/fr/", "allow"), 12: ("net/", "block"), 13: ("net/", "block"), 15: ("net/", "block"), 17: ("", "allow")}
    assert got == sorted((i, *want.get(i, ("", "allow"))) for i, _ in URLS)
    assert judge(pages.limit(0), HOST_RULES, PATTERN_RULES).count() == 0
    split = {r.page_id: (r.host, r.path) for r in judge(pages, [], []).collect()}
    assert split[1] == ("a.example.net", "/en/x") and split[3] == ("b.net", "") and split[8] == ("", "")


RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def exact(text):
    def fits(kind, body):
        digits = [int(c) for c in body if c.isdigit()]
        if kind == "ip":
            return all(int(p) <= 255 for p in body.split("."))
        if kind == "card":
            return 16 <= len(digits) <= 19 and sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(digits[::-1])) % 10 == 0
        return kind == "email" or 8 <= len(digits) <= 15

    return [(k, m.start(), m.end()) for k, (name, p) in enumerate(RULES.items()) for m in re.finditer(p, text or "") if fits(name, m.group())]


def redacted_by_hand(text, spans):
    """Spans from left to right; one that begins inside another replaces what is left of it."""
    out, at = "", 0
    for start, end, kind in sorted((start, end, kind) for kind, start, end in spans):
        if end > at:
            out += (text or "")[at:start] + "[" + list(RULES)[kind].upper() + "]"
            at = end
    return out + (text or "")[at:]


def test_personal_data(spark, rng):
    parts = ["a.b@c.de", "@", "x@y", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111", "+1 (938) 555-1226",
             "+1", "5555", " ", "-", ".", "_", "é", "🙂", "0004", "\n", "(", ")", "e@f.g_h@i.j"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(25))) for _ in range(300)]
    texts += [None, "", "1" * 50000, "a" * 50000, "a@" + "b." * 20000 + "c", "1.2.3.4 " * 3000, "+1" + " (" * 20000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows = with_spans(docs, None, carry=("doc_id", "text"))
    for r in rows.withColumn("clean", redacted(F.col("text"), F.col("spans"))).collect():
        spans = exact(r.text)
        assert [(s.kind, s.start, s.end) for s in r.spans] == sorted(spans) and all(s.base for s in r.spans)
        assert (r.clean or "") == redacted_by_hand(r.text, spans)
    judged = with_spans(docs, fit_judge(docs), carry=("doc_id", "text")).collect()
    assert all({(s.kind, s.start, s.end) for s in r.spans if s.base} == set(exact(r.text)) for r in judged)
    assert fit_judge(docs.limit(0)) is None


def test_contexts_grow_with_the_corpus(spark, monkeypatch):
    def made(k):
        rng = random.Random(k)
        syllables = ["".join(p) for p in itertools.product("bdfgklmnprst", "aeiou")]
        lexicon = ["".join(rng.choices(syllables, k=3)) for _ in range(k)]
        return spark.createDataFrame([(i, " ".join(rng.choices(lexicon, k=400))) for i in range(k // 5)], "doc_id long, text string")

    small, large = made(200), made(1600)
    n = [suffix_tree.fit_suffix_tree(d).entries for d in (small, large)]
    assert n[1] > 3 * n[0] > 0
    # look-ups in several blocks give the same scores
    want = {r.doc_id: r.score for r in score_texts(small, "doc_id % 3 > 0").collect()}
    monkeypatch.setattr(suffix_tree, "BLOCK", n[0] // 3)
    got = {r.doc_id: r.score for r in score_texts(small, "doc_id % 3 > 0").collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[i], want[i], rel_tol=1e-9) for i in want)


def test_rare_divergent_context_scores(spark):
    """A context of one part in a million of the corpus, with a sure next character."""
    rows = [(i, "ab " * 20_000) for i in range(120)] + [(150, "qxzqxw " * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scores = {r.doc_id: r.score for r in score_texts(docs.unionByName(docs.sparkSession.createDataFrame(
        [(200, "qxzqxw"), (201, "wqxzxq")], "doc_id long, text string")), "doc_id < 200").collect()}
    assert scores[200] > scores[201] + 3


def test_memo_forgets_and_trees_keep_their_shape(ranks, monkeypatch):
    from evenkeel.llm import bpe

    monkeypatch.setattr(bpe, "MEMO", 50)
    rng, known = random.Random(9), tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coder = Encoder(ranks, public_tokenizers.PATTERN)
    names = ["".join(rng.choices("abcdeé ", k=rng.randrange(1, 14))) for _ in range(400)]
    for _ in range(30):
        text = " ".join(rng.choices(names, k=200))
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == known.encode_ordinary(text)
        assert len(coder) <= 50 and len(coder.old) <= 50
    tree = TokenTree(text * 20, coder)
    leaves = len(tree.leaves)
    for _ in range(60):  # short edits touch one way up, cuts leave empty leaves
        tree.edit(rng.randrange(len(tree.text)), rng.choice([0, 1, 3000]), rng.choice(["", "x", "new words "]))
        assert tree.tokens == len(known.encode_ordinary(tree.text)) and len(tree.leaves) == leaves
    tree.edit(0, len(tree.text), "")
    assert tree.tokens == 0
    tree.edit(0, 0, text * 30)
    assert tree.tokens == len(known.encode_ordinary(text * 30)) and len(tree.leaves) > leaves


def thue_morse(letters):
    """A word of 1,024 letters and its complement."""
    word = [bin(i).count("1") % 2 for i in range(1024)]
    return "".join(letters[b] for b in word), "".join(letters[1 - b] for b in word)


def test_words_built_to_collide(spark):
    one, other = thue_morse("ab")
    docs = spark.createDataFrame([(1, f"{one} x"), (2, f"{other} x"), (3, f"{one.upper()}\nx")], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join(docs).collect()}
    assert got == {1: 1, 2: 2, 3: 1}
    bench = spark.createDataFrame([(7, one)], "item_id long, text string")
    assert {r.doc_id: r.n_hit for r in decontaminate(docs, bench).collect()} == {1: 1, 2: 0, 3: 1}
    known = {r.doc_id: r.n_known for r in score_texts(docs, "doc_id <> 2").collect()}
    assert known == {1: 3, 2: 2, 3: 3}  # x and the end, and in two texts the long word


def test_toxic_parts_inside_words(spark):
    rows, marks = [], []
    for i in range(800):
        bad = i % 4 == 0
        word = f"{'qwrt'[i % 4]}{'mnpl'[i // 4 % 4]}{i % 7}scoundrel{'zk'[i % 2]}{i % 5}" if bad else f"w{i % 50}"
        rows.append((i, f"plain words and {word} in a line {i % 13}"))
        marks.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    weights, intercept = fit_toxicity(training_sample(docs, labels))
    new = spark.createDataFrame([(1, "aascoundrelee"), (2, "aalanternee"), (3, None), (4, "")], "doc_id long, text string")
    got = {r.doc_id: r.predicted for r in score_toxicity(new, weights, intercept).collect()}
    assert got == {1: 1, 2: 0, 3: 0, 4: 0}
