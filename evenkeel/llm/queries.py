"""One query per operator, over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from evenkeel.llm.bpe import encode, read_ranks
from evenkeel.llm.decontaminate import decontaminate
from evenkeel.llm.divergence import divergence_audit
from evenkeel.llm.jaccard import jaccard_join
from evenkeel.llm.language import fit_language, identify, training_rows
from evenkeel.llm.manifest import merkle_manifest
from evenkeel.llm.multi_index import near_vectors
from evenkeel.llm.neighbours import nearest
from evenkeel.llm.pii import BASE, count_of, digest, fit_judge, with_spans
from evenkeel.llm.suffix_tree import score_texts, training_condition
from evenkeel.llm.texts import fold
from evenkeel.llm.token_counts import edited_counts
from evenkeel.llm.toxicity import fit_toxicity, score_toxicity, training_sample
from evenkeel.llm.url_rules import HostRule, PatternRule, judge

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- 1: personal data


@query()
def op1_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    """Personal data in all documents: exact rules, and what trees add."""
    docs = _table(spark, sf, "documents")
    rows = with_spans(docs, fit_judge(docs))
    spans = F.col("spans")
    counts = [count_of(spans, k).alias(f"n_{name}") for k, name in enumerate(BASE)]
    return rows.select(
        "doc_id", *counts, F.sha2(digest(spans, True), 256).alias("base_sha256"), digest(spans, False).alias("spans"),
        F.size(spans).cast("long").alias("n_spans"))


# --- 2: nearest neighbours


@query(sql="""
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL),
ok AS (SELECT vec_id, e FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND list_dot_product(e, e) > 0),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id,
    list_dot_product(q.e, c.e) / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(c.e, c.e))) AS score
  FROM ok q JOIN ok c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""")
def op2_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """The five nearest rows of every fiftieth vector."""
    vectors = _table(spark, sf, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0))


# --- 3: language-model scores


@query()
def op3_lm_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Log probabilities of all documents, learned from six folds of seven."""
    return score_texts(_table(spark, sf, "documents"), training_condition(7, 2))


# --- 4: language


@query()
def op4_language(spark: SparkSession, sf: str) -> DataFrame:
    """Languages of all documents, learned from four folds of five."""
    docs = _table(spark, sf, "documents")
    held_out = (fold("doc_id", 5) == 0).alias("held_out")
    return identify(
        docs.select("doc_id", "text", held_out), fit_language(training_rows(docs)), carry=("doc_id", "held_out"))


# --- 5: URL filters

HOST_RULES = [
    HostRule("block", "net/"), HostRule("allow", "example.net/en/"),
    HostRule("block", "example.com/de/"), HostRule("allow", "org/fr/"),
]
#: Names that tell of advertising, gambling, spam and the like.
PATTERN_RULES = [
    PatternRule("block", r"://([^/?#]*[.])?ads-track[.]", ("ads", "track")),
    PatternRule("block", r"://([^/?#]*[.])?cheap-pills[.]", ("cheap", "pills")),
    PatternRule("block", r"://([^/?#]*[.])?casino-[a-z]+[.]", ("casino",)),
    PatternRule("block", r"://([^/?#]*[.])?spam-farm[.]", ("spam", "farm")),
    PatternRule("block", r"://([^/?#]*[.])?free-bets[.]", ("free", "bets")),
    PatternRule("block", r"://([^/?#]*[.])?adult-[a-z]+[.]", ("adult",)),
    PatternRule("block", r"[?&]utm_medium=affiliate(&|#|$)", ("utm", "medium", "affiliate")),
    PatternRule("allow", r"://[^/?#]+/robots[.]txt$", ("robots", "txt")),
]
_MATCHES = {v: " OR ".join(f"regexp_matches(lower(url), '{r.pattern}')" for r in PATTERN_RULES if r.verdict == v)
            for v in ("allow", "block")}


@query(sql=f"""
WITH u AS (SELECT page_id, url, row_number() OVER () AS n,
    coalesce(CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END, '') AS rest FROM pages),
p AS (SELECT *, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(text, verdict) AS (VALUES {", ".join(f"('{r.text}', '{r.verdict}')" for r in HOST_RULES)}),
parts AS (SELECT text, verdict, split_part(text, '/', 1) AS h, substr(text, instr(text, '/')) AS pre FROM rules),
best AS (SELECT n, arg_max(text, len(text)) AS rule, arg_max(verdict, len(text)) AS v FROM p JOIN parts
  ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, pre) GROUP BY n)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN {_MATCHES["allow"]} THEN 'allow'
  WHEN {_MATCHES["block"]} THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN best USING (n)""")
def op5_url_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Verdicts on all page URLs."""
    return judge(_table(spark, sf, "pages"), HOST_RULES, PATTERN_RULES)


# --- 6: byte-level BPE

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


@query()
def op6_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of all documents, and the bytes they decode to."""
    ranks = read_ranks(public_tokenizers.path(VOCABULARY))
    return encode(_table(spark, sf, "documents"), ranks, public_tokenizers.PATTERN, digests=True)


# --- 8: token counts


def with_edits(docs: DataFrame) -> DataFrame:
    """Three edits of every document: its id put in after a third, forty
    characters from the middle in upper case, the last tenth gone."""
    n, number = F.length("text"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    middle = F.floor(n / 2).cast("int")
    third = F.floor(n / 3).cast("int")
    longer = n + F.length(number) + 2
    kept = F.floor(longer * 0.9).cast("int")

    def one(at, remove, insert):
        return F.struct(at.alias("at"), remove.alias("remove"), insert.alias("insert"))

    return docs.withColumn("edits", F.array(
        one(third, F.lit(0), F.concat(F.lit(" "), number, F.lit(" "))),
        one(middle, F.lit(40), F.upper(F.substring("text", middle + 1, F.lit(40)))),
        one(kept, longer - kept, F.lit(""))))


@query()
def op8_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of all documents before and after edits."""
    ranks = read_ranks(public_tokenizers.path(VOCABULARY))
    docs = with_edits(_table(spark, sf, "documents").select("doc_id", "text"))
    return edited_counts(docs, ranks, public_tokenizers.PATTERN)


# --- 7: n-gram Jaccard join

_TOKENS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"


@query(sql=f"""
WITH RECURSIVE d AS (SELECT doc_id, {_TOKENS} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, list_slice(w, p, p + least(4, len(w)) - 1) AS sh FROM
  (SELECT doc_id, w, unnest(range(1, len(w) - least(4, len(w)) + 2)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id
  GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least_id AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least_id.b AS component_id,
  (SELECT count(*) FROM links WHERE links.a = d.doc_id)::BIGINT AS n_links
FROM d LEFT JOIN n USING (doc_id) JOIN least_id ON least_id.a = d.doc_id""")
def op7_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    """Components of documents that share 85 percent of their 4-word shingles."""
    return jaccard_join(_table(spark, sf, "documents")).drop("class_id")


# --- 9: benchmark decontamination

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(sql=f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS k, list_slice(w, p, p + least(13, len(w)) - 1) AS run
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)),
place AS (
  SELECT doc_id, k, p, list_slice(w, p, p + k - 1) AS run
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p
        FROM d, (SELECT DISTINCT k FROM win) WHERE len(w) >= k)),
hits AS (SELECT doc_id, p, place.k, item_id FROM place JOIN win ON place.run = win.run AND place.k = win.k),
spots AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM
  (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN spots USING (doc_id) LEFT JOIN found USING (doc_id)""")
def op9_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Words of documents inside passages of benchmark items."""
    return decontaminate(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


# --- 10: toxicity


@query()
def op10_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of all documents, learned from labels of four folds of five."""
    docs = _table(spark, sf, "documents")
    weights, intercept = fit_toxicity(training_sample(docs, _table(spark, sf, "labels")))
    held_out = (fold("doc_id", 5) == 0).alias("held_out")
    return score_toxicity(docs.select("doc_id", "text", held_out), weights, intercept, carry=("doc_id", "held_out"))


# --- 11: Merkle manifest


def _crc_table() -> list[int]:
    """What each byte does to a CRC-32, from its polynomial."""
    table = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        table.append(byte)
    return table


_FIELD = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"


def _leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


def _levels_sql(name: str, leaves: str) -> str:
    """CTE: all nodes (tree, level, pos, h) above ``leaves`` (tree, pos, h)."""
    return f"""{name} AS (
  SELECT tree, 0 AS level, pos, h, count(*) OVER (PARTITION BY tree) AS n FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM {name} WHERE n > 1
  GROUP BY tree, level, pos // 2, n)"""


def _steps_sql(nodes: str, leaves: str) -> str:
    """Per leaf of a tree, the siblings on its way up with their side."""
    return f"""SELECT l.tree, l.pos, list(CASE WHEN s.h IS NULL THEN 'N' WHEN (l.pos >> o.level) % 2 = 1 THEN 'L' || s.h
      ELSE 'R' || s.h END ORDER BY o.level) FILTER (o.n > 1) AS steps
  FROM {leaves} l JOIN {nodes} o ON o.tree = l.tree AND o.pos = (l.pos >> o.level)
  LEFT JOIN {nodes} s ON s.tree = l.tree AND s.level = o.level AND s.pos = xor(l.pos >> o.level, 1) GROUP BY l.tree, l.pos"""


@query(sql=f"""
WITH RECURSIVE crc AS (SELECT {_crc_table()} AS t),
d AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf_sql("n_chars")} AS h,
    {_leaf_sql("(n_chars + 1)")} AS other,
    xor(list_reduce(list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT FOR c IN string_split(doc_id::VARCHAR, '')]),
      lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1]::BIGINT)), 4294967295) % 7 = 0 AND n_chars IS NOT NULL AS hit
  FROM documents, crc),
leaves AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM d),
{_levels_sql("nodes", "leaves")},
subroots AS MATERIALIZED (SELECT tree AS lang, '' AS tree, h, row_number() OVER (ORDER BY tree) - 1 AS pos FROM nodes WHERE n = 1),
{_levels_sql("tops", "subroots")},
lower_steps AS ({_steps_sql("nodes", "leaves")}),
upper_steps AS ({_steps_sql("tops", "subroots")}),
ways AS (SELECT l.*, s.h AS subroot, coalesce(a.steps, []) || coalesce(b.steps, []) AS steps FROM leaves l
  JOIN lower_steps a ON a.tree = l.tree AND a.pos = l.pos JOIN subroots s ON s.lang = l.tree JOIN upper_steps b ON b.pos = s.pos),
folded AS (SELECT *, list_reduce(list_prepend(CASE WHEN hit THEN other ELSE h END, steps), lambda a, s: sha256(
    CASE s[1] WHEN 'L' THEN s[2:] || a WHEN 'R' THEN a || s[2:] ELSE a END)) AS folded_root FROM ways)
SELECT doc_id, h AS leaf, subroot, (SELECT h FROM tops WHERE n = 1) AS root,
  sha256(array_to_string([s[2:] FOR s IN steps], '')) AS proof_sha256, folded_root,
  folded_root = (SELECT h FROM tops WHERE n = 1) AS verified FROM folded""")
def op11_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Leaves, roots and proofs of all documents, some of them tampered with."""
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return merkle_manifest(_table(spark, sf, "documents"), tampered)


# --- 12: source divergence audit

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"


@query(sql=f"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_TERMS} AS w FROM documents),
t AS (SELECT doc, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS c FROM t GROUP BY ALL HAVING count(DISTINCT doc) >= 10),
whole AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM d),
own AS (SELECT lang, source, term, count(*) AS c FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
total AS (SELECT lang, source, sum(c) AS n FROM own GROUP BY ALL),
r AS (SELECT lang, source, term, coalesce(own.c, 0) AS c,
    1 + (1000000000::HUGEINT * (coalesce(own.c, 0) + 2)) // (coalesce(total.n, 0) + 2 * v) AS p,
    1 + (1000000000::HUGEINT * (kept.c + 2)) // (whole.n + 2 * v) AS q
  FROM grp JOIN kept USING (lang) JOIN whole USING (lang) LEFT JOIN own USING (lang, source, term) LEFT JOIN total USING (lang, source)),
gaps AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM r a JOIN r b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
rows_ AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM grp a
    JOIN grp b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN gaps g ON g.lang = a.lang AND g.source = a.source AND g.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM r WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank FROM (SELECT *,
  row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM rows_)
WHERE part = 'pair' OR rank <= 10""")
def op12_divergence_audit(spark: SparkSession, sf: str) -> DataFrame:
    """How far term rates of sources lie apart, and what each one overuses."""
    return divergence_audit(_table(spark, sf, "documents"))


# --- 13: embedding near-dedup


@query(sql="""
WITH RECURSIVE v AS (SELECT row_number() OVER () AS row, vec_id, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (SELECT row, vec_id, e FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND list_dot_product(e, e) > 0),
links AS MATERIALIZED (SELECT a.row AS a, b.row AS b, b.vec_id FROM ok a JOIN ok b ON a.row <> b.row AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.9),
reach AS (SELECT row AS a, row AS b, vec_id FROM v
  UNION SELECT reach.a, links.b, links.vec_id FROM reach JOIN links ON reach.b = links.a),
least_id AS (SELECT a, min(vec_id) AS component_id FROM reach GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = v.row)::BIGINT AS n_links, component_id,
  vec_id IS NOT DISTINCT FROM component_id AS kept FROM v JOIN least_id ON least_id.a = v.row""")
def op13_near_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Links and components of all vectors of a cosine of 0.9 or more."""
    return near_vectors(_table(spark, sf, "embeddings"))
