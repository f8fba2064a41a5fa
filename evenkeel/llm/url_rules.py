"""URL filtering by pattern rules behind an index of their rarest tokens.

Tokens are runs of lower-case letters and digits. Every pattern rule names the
literal tokens that a URL must hold for it to match. Each rule is indexed by the
one that the fewest URLs of the table hold. A URL fetches the rules of its tokens,
and only those run their regular expressions. Host rules (a host, its subdomains
and a path prefix) are rules of the same index, with tokens from their text.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.texts import pick

BLOCK, ALLOW = "block", "allow"
#: Rules whose index is broadcast; more are joined by a shuffle.
BROADCAST_RULES = 50_000


class HostRule(NamedTuple):
    """``text``: a host, a slash and a path prefix."""

    verdict: str
    text: str


class PatternRule(NamedTuple):
    """``pattern`` is searched in the lower-cased URL, and can only match where
    all ``tokens`` are whole tokens of it."""

    verdict: str
    pattern: str
    tokens: tuple[str, ...]


def _tokens(url: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(url), F.lit("([a-z0-9]+)"), 1))


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without a scheme."""
    held = url.contains("://")
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return (F.when(held, lowered).otherwise("").alias("host"), F.when(held, path).otherwise("").alias("path"))


def judge(
    pages: DataFrame, hosts: Sequence[HostRule], patterns: Sequence[PatternRule], default: str = ALLOW
) -> DataFrame:
    """Judge the ``url`` of every row of ``pages`` (page_id, url).

    Returns page_id, host, path, rule (the text of the longest host rule that
    fits; ties to blocking, then to the text; else null) and verdict: the host
    rule's, else that of the pattern rules that match (one that allows beats
    those that block), else ``default``.

    Null URLs and those without ``://`` have an empty host and path; a pattern
    may still match the text. Repeated rows are judged one by one.
    """
    spark = pages.sparkSession
    host, path = split_url(F.col("url"))
    rows = pick(pages, "page_id", "url").select("page_id", "url", host, path)
    rules = [("host", r.verdict, r.text, r.text.partition("/")[0], "/" + r.text.partition("/")[2], None,
              re.findall("[a-z0-9]+", r.text.partition("/")[0])) for r in hosts]
    rules += [("pattern", r.verdict, None, None, None, r.pattern, list(r.tokens)) for r in patterns]
    if any(not r[-1] for r in rules):
        raise ValueError("a rule needs a literal token")
    table = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rules)],
        "id int, kind string, verdict string, text string, r_host string, r_path string, pattern string, tokens array<string>")
    wanted = sorted({t for r in rules for t in r[-1]})
    # how many URLs hold each token of a rule: one count per token and task is shuffled
    held = F.explode(F.array_intersect(_tokens(F.col("url")), F.array(*map(F.lit, wanted)))) if wanted else None
    counts = {} if held is None else {
        r["t"]: r["n"] for r in rows.select(held.alias("t")).groupBy("t").agg(F.count("*").alias("n")).collect()}
    rarest = {i: min(r[-1], key=lambda t: (counts.get(t, 0), t)) for i, r in enumerate(rules)}
    index = table.join(spark.createDataFrame(list(rarest.items()) or [(None, None)], "id int, token string"), "id").drop("tokens")
    if len(rules) <= BROADCAST_RULES:
        index = F.broadcast(index)

    numbered = rows.withColumn("row", F.monotonically_increasing_id()).withColumn("low", F.lower("url"))
    # a URL without tokens keeps its row
    dealt = numbered.withColumn("token", F.explode_outer(_tokens(F.col("url"))))
    fetched = dealt.join(index, "token", "left")
    fits = (F.col("kind") == "host") & ((F.col("host") == F.col("r_host")) | F.endswith(
        F.col("host"), F.concat(F.lit("."), F.col("r_host")))) & F.startswith(F.col("path"), F.col("r_path"))
    best = F.when(fits, F.struct(F.length("text").alias("size"), (F.col("verdict") == BLOCK).alias("blocks"), "text", "verdict"))
    matched = (F.col("kind") == "pattern") & F.expr("regexp_like(low, pattern)")
    judged = fetched.groupBy("row").agg(
        F.any_value("page_id").alias("page_id"), F.any_value("host").alias("host"), F.any_value("path").alias("path"),
        F.max(best).alias("best"),
        F.max(F.when(matched & (F.col("verdict") == ALLOW), 1)).alias("allowed"),
        F.max(F.when(matched & (F.col("verdict") == BLOCK), 1)).alias("blocked"))
    verdict = F.coalesce(
        F.col("best.verdict"), F.when(F.col("allowed") == 1, ALLOW), F.when(F.col("blocked") == 1, BLOCK), F.lit(default))
    return judged.select("page_id", "host", "path", F.col("best.text").alias("rule"), verdict.alias("verdict"))
