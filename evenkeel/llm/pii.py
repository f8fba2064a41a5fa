"""Personal data: candidate spans, boosted trees, calibrated thresholds.

Exact rules find the base spans of each kind. High-recall generators propose
more spans, which may overlap: matches that fail a rule's check, sound parts of
such matches, written-out addresses, other spacing, numbers without a country
code, long network addresses, account numbers, access keys.

Boosted trees judge candidates by format and context. Their positive examples
are spans of the base and, for each looser form, base spans rewritten into
that form where they stand; their negative ones are all other candidates of the
same generators. All documents and candidates are learned from. What sets a form off (its at sign, its plus)
is no feature. Per generator, a threshold is set on candidates kept out of the
fit, so that at most one document in FALSE_ALARM has a negative candidate above
it; candidates above it are added, from left to right, where they touch no other
span. A form whose kind has no base span is not learned and adds nothing.

All of it is DataFrame and SQL functions. Spans are arrays within a row: finding,
judging and redacting need no shuffle. The fitted trees are small and become SQL
expressions.

Patterns are possessive forms of the base rules that find the same matches
without backtracking into them, so long texts neither overflow a stack nor take
quadratic time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.texts import checked, pick
from evenkeel.sources.shared import materialize

#: The first four have exact rules; iban and secret only looser ones.
KINDS = ("email", "ip", "card", "phone", "iban", "secret")
_LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_HEX = "[0-9A-Fa-f]{1,4}"


class Form(NamedTuple):
    """A looser generator: its kind, pattern, a cheap test of texts, and how to
    rewrite base spans of a kind (None: of any) into its form, as SQL texts over ``body``."""

    kind: str
    pattern: str
    worth: str
    source: str | None
    rewrite: tuple[str, ...]


_PLAIN = "regexp_replace(body, '[^0-9]', '')"
FORMS = (
    Form("email", rf"(?<!{_LOCAL}){_LOCAL}++(?: @ | ?[(\[{{](?:at|AT)[)\]}}] ?)[A-Za-z0-9-]++(?:(?:\.| ?[(\[{{](?:dot|DOT)[)\]}}] ?)[A-Za-z0-9-]++)++",
         r" @ |[(\[{](?:at|AT)[)\]}]", "email",
         ("replace(replace(body, '@', ' (at) '), '.', ' (dot) ')", "replace(body, '@', ' @ ')", "replace(replace(body, '@', '[at]'), '.', '[dot]')")),
    Form("email", rf"(?<!{_LOCAL}){_LOCAL}++ (?:at|AT) [A-Za-z0-9-]++(?: (?:dot|DOT) [A-Za-z0-9-]++)++", " (?:dot|DOT) ", "email",
         ("replace(replace(body, '@', ' at '), '.', ' dot ')",)),
    Form("ip", rf"{_OCTET}(?:(?:\.|\[\.\]| \. ){_OCTET}){{3}}(?![0-9])", r"[0-9](?:\.|\[\.\]| \. )[0-9]", "ip",
         ("replace(body, '.', '[.]')", "concat('900', body)", "replace(body, '.', ' . ')")),
    Form("ip", rf"(?<![0-9A-Za-z:.])(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{1,6}}(?::{_HEX}){{1,6}})(?![0-9A-Za-z:])", f"{_HEX}:{_HEX}:", None,
         ("concat('2001:db8', regexp_replace(substring(md5(body), 1, 24), '(.{4})', ':$1'))",
          "concat('fe80::', substring(md5(body), 1, 4), ':', substring(md5(body), 5, 4))")),
    Form("card", r"(?<![0-9])[0-9]{4}(?:(?:\x20\x20|[./_\x20-]|\x20-\x20)[0-9]{4}){2}(?:(?:\x20\x20|[./_\x20-]|\x20-\x20)[0-9]{1,4}){1,2}",
         "[0-9]{4}[./_ -]{1,3}[0-9]{4}", "card",
         (rf"regexp_replace({_PLAIN}, '([0-9]{{4}})(?=[0-9])', '$1.')", rf"regexp_replace({_PLAIN}, '([0-9]{{4}})(?=[0-9])', '$1  ')",
          rf"concat(regexp_replace({_PLAIN}, '([0-9]{{4}})(?=[0-9])', '$1-'), '.5')")),
    Form("phone", r"(?<![0-9+])(?<![0-9][.\x20-])\(?[0-9]{2,5}\)?(?:[.\x20-]{1,2}\(?[0-9]{2,5}\)?){1,4}+(?![0-9])", "[0-9]{2}[). -]{1,2}[(0-9]", "phone",
         (r"regexp_replace(body, '^.[0-9]{1,3}[ .-]+', '')", r"regexp_replace(body, '^.[0-9]{1,3}[ .-]+', '0')")),
    Form("phone", r"\+[0-9]{1,3}[.\x20-]?\(?[0-9]{2,4}\)?(?:[.\x20-][0-9]{2,4}){2,4}", r"\+[0-9]", "phone",
         ("concat(body, '0000000041')",)),
    Form("iban", r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[0-9A-Z]{4}){2,7}+(?:\x20?[0-9A-Z]{1,3})?+(?![0-9A-Za-z])", "[A-Z]{2}[0-9]{2} ?[0-9A-Z]{4}", None,
         ("""concat('DE', lpad(cast(98 - pmod(cast(concat(lpad(cast(abs(xxhash64(body)) % 1000000000 as string), 9, '7'), '370400044131400') as decimal(38, 0)), 97) as string), 2, '0'),
             lpad(cast(abs(xxhash64(body)) % 1000000000 as string), 9, '7'), '370400044')""",)),
    Form("secret", r"(?<![0-9A-Za-z])(?:AKIA[0-9A-Z]{16}|gh[a-z]_[0-9A-Za-z]{30,80}+|sk-[0-9A-Za-z_-]{20,200}+|xox[a-z]-[0-9A-Za-z-]{10,200}+|AIza[0-9A-Za-z_-]{35})(?![0-9A-Za-z])",
         "AKIA|gh[a-z]_|sk-|xox[a-z]-|AIza", None,
         ("concat('AKIA', upper(substring(md5(body), 1, 16)))", "concat('ghp_', md5(body), 'Abcd')", "concat('sk-', md5(body))")),
    Form("secret", r"(?i:password|passwd|api[_-]?key|secret|token)[\"']?\x20?[=:]\x20?[\"']?[!-&(-~]{8,200}+", "(?i)(?:password|passwd|api[_-]?key|secret|token)[\"']?\x20?[=:]", None,
         ("concat('password: ', substring(md5(body), 1, 14))", "concat('api_key=', md5(body))")),
)
#: Generators by number: the exact rules, then the looser forms.
GENERATORS = [(KINDS.index(kind), pattern) for kind, pattern in BASE.items()] + [(KINDS.index(f.kind), f.pattern) for f in FORMS]
#: The candidates of a generator and label weigh as much as so many, at most.
EVEN = 2_000
TREES, TREE_DEPTH = 16, 4
#: One document in so many may have a negative candidate above the threshold of a generator.
FALSE_ALARM = 500
#: Of failed matches of a rule: least share of the base among candidates above a threshold.
PRECISION = 0.95
BEFORE, AFTER = 24, 12
_PART = 256


_MATCHES = "array<struct<start:int,end:int,body:string,before:string,after:string>>"


def _places(steps: Column) -> Column:
    """Matches as structs of start, end (characters, end exclusive), body and the
    text around, from structs of the length before a match, the match and that text.

    Places are running sums: within parts of _PART matches first, then over the
    parts, so that many matches do not take quadratic time.
    """
    count = F.ceil(F.size(steps) / F.lit(_PART)).cast("int")
    parts = F.when(count > 0, F.transform(
        F.sequence(F.lit(0), count - 1), lambda b: F.slice(steps, b * _PART + 1, F.lit(_PART))))

    def walk(part: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast(_MATCHES).alias("out"))

        def step(s: Column, x: Column) -> Column:
            low = s["at"] + x["gap"]
            high = low + F.length(x["body"])
            one = F.struct(low.alias("start"), high.alias("end"), x["body"].alias("body"),
                           x["before"].alias("before"), x["after"].alias("after"))
            return F.struct(high.alias("at"), F.concat(s["out"], F.array(one)).alias("out"))

        return F.aggregate(part, start, step)

    def join(s: Column, p: Column) -> Column:
        moved = F.transform(p["out"], lambda x: F.struct(
            (x["start"] + s["at"]).alias("start"), (x["end"] + s["at"]).alias("end"), x["body"].alias("body"),
            x["before"].alias("before"), x["after"].alias("after")))
        return F.struct((s["at"] + p["at"]).alias("at"), F.concat(s["out"], F.array(moved)).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_MATCHES}>").alias("out"))
    return F.flatten(F.aggregate(F.transform(parts, walk), start, join)["out"])


def _digits(body: Column) -> Column:
    return F.regexp_replace(body, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits pass the Luhn check."""
    turned = F.reverse(digits)

    def value(i: Column) -> Column:
        d = F.substring(turned, i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    places = F.sequence(F.lit(1), F.length(digits))
    return F.aggregate(places, F.lit(0), lambda s, i: s + value(i)) % 10 == 0


def _valid(kind: str, body: Column) -> Column:
    digits = _digits(body)
    if kind == "ip":
        short = F.transform(F.split(body, r"\."), lambda p: F.ltrim(p, F.lit("0")))
        return F.forall(short, lambda p: F.when(F.length(p) <= 3, F.coalesce(p.try_cast("int"), F.lit(0)) <= 255).otherwise(False))
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _mod97(body: Column) -> Column:
    """An account number's remainder: its first four characters last, letters as 10 to 35."""
    plain = F.replace(body, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def step(s: Column, c: Column) -> Column:
        n = F.when(c.rlike("[0-9]"), c.try_cast("int")).otherwise(F.ascii(c) - 55)
        return (s * F.when(n > 9, 100).otherwise(10) + n) % 97

    return F.aggregate(F.split(turned, ""), F.lit(0), lambda s, c: F.when(c == "", s).otherwise(step(s, c)))


def _sound(form: Form, body: Column) -> Column:
    """Whether a looser match is proposed at all."""
    digits = F.length(_digits(body))
    if form.kind == "card":
        return _valid("card", body)
    if form.kind == "phone":
        return digits.between(7, 15)
    if form.kind == "iban":
        return _mod97(body) == 1
    return F.lit(True)


def _worth(g: int, text: Column) -> Column:
    """A cheap test that texts without any match fail."""
    if g >= len(BASE):
        return text.rlike(FORMS[g - len(BASE)].worth)
    return text.contains("@") if g == 0 else text.contains("+") if g == 3 else text.rlike("[0-9]")


_SPANS = "array<struct<gen:int,kind:int,start:int,end:int,body:string,before:string,after:string,base:boolean>>"


def _marked(g: int) -> Callable[[Column], Column]:
    kind = GENERATORS[g][0]
    return lambda x: F.struct(
        F.lit(g).alias("gen"), F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
        x["body"].alias("body"), x["before"].alias("before"), x["after"].alias("after"),
        (_valid(KINDS[kind], x["body"]) if g < len(BASE) else F.lit(False)).alias("base"))


def with_candidates(docs: DataFrame, only: str | None = None) -> DataFrame:
    """``docs`` with ``found``, all candidate spans of ``text`` (with ``only``, those of
    the generator that this column names); ``base`` marks those of the exact rules.

    Text between matches and matches alternate, which gives places and the text
    around. Each step is a column of its own, so that nothing is searched twice.
    """
    text = F.coalesce("text", F.lit(""))
    every = range(len(GENERATORS))
    asked = [F.lit(True) if only is None else F.col(only) == g for g in every]
    steps = docs.withColumns({f"__g{g}": F.when(asked[g] & _worth(g, text), F.split(text, GENERATORS[g][1], -1)) for g in every})
    # a text that is not cut has no matches
    steps = steps.withColumns({f"__m{g}": F.when(
        F.size(f"__g{g}") > 1, F.regexp_extract_all(text, F.lit(GENERATORS[g][1]), 0)) for g in every})

    def around(g: int) -> Column:
        gaps, bodies = F.col(f"__g{g}"), F.col(f"__m{g}")

        def one(body: Column, i: Column) -> Column:
            gap, behind = F.get(gaps, i), F.get(gaps, i + 1)
            last, following = F.coalesce(F.get(bodies, i - 1), F.lit("")), F.coalesce(F.get(bodies, i + 1), F.lit(""))
            before = F.right(F.concat(F.right(last, F.lit(BEFORE)), F.right(gap, F.lit(BEFORE))), F.lit(BEFORE))
            after = F.left(F.concat(F.left(behind, F.lit(AFTER)), F.left(following, F.lit(AFTER))), F.lit(AFTER))
            return F.struct(F.length(gap).alias("gap"), body.alias("body"), before.alias("before"), after.alias("after"))

        return F.transform(bodies, one)

    steps = steps.withColumns({f"__s{g}": around(g) for g in every})
    lists = []
    for g in every:
        made = F.transform(_places(F.col(f"__s{g}")), _marked(g))
        if g >= len(BASE):
            form = FORMS[g - len(BASE)]
            made = F.filter(made, lambda x: _sound(form, x["body"]))
        lists.append(F.when(F.col(f"__s{g}").isNotNull(), made).otherwise(F.array().cast(_SPANS)))
    own = [f"__{c}{g}" for g in every for c in "gms"]
    return steps.withColumn("found", F.concat(*lists)).drop(*own)


def _count(body: Column, chars: str) -> Column:
    return F.length(body) - F.length(F.regexp_replace(body, chars, ""))


FEATURES = ("gen", "length", "digits", "letters", "spaces", "dashes", "dots", "brackets",
            "word_before", "word_after", "digit_before", "digit_after", "quote_before", "assigned", "named", "groups")


def _features(x: Column) -> Column:
    """Format and context of a candidate, in the order of FEATURES. What the
    checks look at (the check sum, the largest part of an address) is left out."""
    body, before, after = x["body"], x["before"], x["after"]
    named = r"(?i)(mail|phone|tel|call|fax|mobil|card|konto|carte|tarjeta|host|addr|ip|iban|key)[a-z]*\W{0,3}$"
    parts = [
        x["gen"], F.length(body), _count(body, "[0-9]"), _count(body, "[A-Za-z]"), _count(body, " "), _count(body, "-"),
        _count(body, r"\."), _count(body, r"[()\[\]]"),
        before.rlike(r"\w$"), after.rlike(r"^\w"), before.rlike(r"[0-9][ .,-]?$"), after.rlike("^[ .,-]?[0-9]"),
        before.rlike("[\"'`]$"), before.rlike(r"[=:]\s*[\"']?$"), before.rlike(named), F.size(F.split(body, "[^0-9A-Za-z]+")),
    ]
    return F.array(*[p.cast("double") for p in parts])


class Judge(NamedTuple):
    """Trees as (weight, nodes) and the least probability by generator; a node is a
    number, or (feature, threshold, node at most, node above)."""

    trees: tuple
    least: tuple

    def probability(self, features: Column) -> Column:
        def value(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            feature, threshold, low, high = node
            return F.when(features[feature] <= threshold, value(low)).otherwise(value(high))

        total = F.lit(0.0)
        for weight, node in self.trees:
            total = total + weight * value(node)
        return 1 / (1 + F.exp(-2 * total))


def _parsed(lines: list[str]):
    """The nodes of a tree from its printed form."""
    line = lines.pop(0)
    if line.startswith("Predict:"):
        return float(line.split()[1])
    feature, threshold = int(line.split()[2]), float(line.split()[4].rstrip(")"))
    low = _parsed(lines)
    lines.pop(0)  # Else
    return feature, threshold, low, _parsed(lines)


def _rewritten(spans: DataFrame) -> DataFrame:
    """Candidates of looser forms in base spans (gen, body, before, after) rewritten
    where they stand."""
    forms = []
    for f, form in enumerate(FORMS):
        source = F.lit(True) if form.source is None else F.col("kind") == KINDS.index(form.source)
        forms += [F.when(source, F.struct(F.lit(len(BASE) + f).alias("form"), F.expr(sql).alias("made"))) for sql in form.rewrite]
    # Spark would filter by the size of a list it explodes, and make that list once more to do so; not with outer
    each = spans.select("body", "before", "after", F.explode_outer(F.array_compact(F.array(*forms))).alias("one")).where("one IS NOT NULL")
    each = each.select("before", "one.*", F.concat("before", "one.made", "after").alias("text"))
    low = F.length("before")
    found = with_candidates(each, "form").select("form", low.alias("low"), (low + F.length("made")).alias("high"), F.explode_outer("found").alias("x"))
    return found.where("x.start < high AND low < x.end").select("x")


def fit_judge(docs: DataFrame, even: int = EVEN) -> Judge | None:
    """Fit trees and thresholds on all candidates of all ``docs`` (text).

    Candidates of a generator and label weigh as much as ``even`` of them
    where there are more, so that frequent ones do not drown out the others.
    Without candidates of both labels there is nothing to learn and None is
    returned; then nothing is added to the base.
    """
    rows = pick(docs, "text").where("text IS NOT NULL")
    found = with_candidates(rows).withColumn("exact", F.filter("found", lambda x: x["base"]))
    # what touches the base is no counter-example
    found = found.withColumn("apart", _free(F.col("found"), F.col("exact")))
    found = found.select(F.xxhash64("text").alias("doc"), F.explode_outer(F.concat("exact", "apart")).alias("x"))
    found = materialize(found.where("x IS NOT NULL"), "candidates")
    own = found.select("doc", "x", F.col("x.base").alias("label"))
    # few bytes, much work: dealt to all tasks
    spans = found.where("x.base").groupBy(F.xxhash64("x.body", "x.before").alias("h")).agg(F.first("x").alias("x"))
    new = _rewritten(spans.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "h").select("x.*"))
    every = own.unionByName(new.select(F.xxhash64("x.body", "x.before").alias("doc"), "x", F.lit(True).alias("label")))
    every = materialize(every.select(
        F.xxhash64("doc", "x.start", "x.body").alias("key"), "doc", F.col("x.gen").alias("generator"), "label", _features(F.col("x")).alias("f")), "judged")
    totals = every.groupBy("generator", "label").count().collect()
    weights = {(r["generator"], r["label"]): min(1.0, even / r["count"]) for r in totals}
    if len({label for _, label in weights}) < 2:
        return None
    weight = F.coalesce(*[F.when((F.col("generator") == g) & (F.col("label") == label), F.lit(v)) for (g, label), v in weights.items()])
    every = every.select("key", "label", weight.alias("weight"), *[F.col("f")[i].alias(n) for i, n in enumerate(FEATURES)])
    every = materialize(every.orderBy("key", "gen", "label").withColumn("label", F.col("label").cast("double")), "examples")
    fit = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(every).where(F.pmod("key", F.lit(3)) != 0)
    if fit.select("label").distinct().count() < 2:
        return None
    model = GBTClassifier(maxIter=TREES, maxDepth=TREE_DEPTH, stepSize=0.3, seed=7, weightCol="weight").fit(fit.select("features", "label", "weight"))
    trees = []
    for weight, tree in zip(model.treeWeights, model.trees):
        lines = [s.strip() for s in tree.toDebugString.splitlines()[1:] if s.strip()]
        trees.append((float(weight), _parsed(lines)))
    judge = Judge(tuple(trees), ())
    # rounded down, so that a threshold is never above the candidates that set it
    p = F.floor(1000 * judge.probability(F.array(*[F.col(n) for n in FEATURES]))) / 1000
    seen = every.where(F.pmod("key", F.lit(3)) == 0).groupBy("gen", p.alias("p")).agg(
        F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("bad")).orderBy("gen", F.desc("p")).collect()
    documents = rows.count()
    least = []
    for g in range(len(GENERATORS)):
        # candidates kept out are a third of all
        allowed = documents / FALSE_ALARM / 3
        good, bad, bar = 0.0, 0.0, 2.0  # a probability that nothing reaches
        for r in (r for r in seen if r["gen"] == g):
            good, bad = good + r["good"], bad + r["bad"]
            weighed = weights.get((g, True), 1.0) * good, weights.get((g, False), 1.0) * bad
            if good and bad <= allowed and (g >= len(BASE) or weighed[0] >= PRECISION * sum(weighed)):
                bar = r["p"]
        least.append(bar)
    return Judge(tuple(trees), tuple(least))


def _touch(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def _free(found: Column, base: Column) -> Column:
    """The candidates that touch no span of the base. Each part of _PART, in order of
    place, is held against the base spans near it, so that long lists of both do
    not meet in full."""
    others = F.array_sort(F.transform(F.filter(found, lambda x: ~x["base"]), lambda x: F.struct(x["start"].alias("start"), x.alias("x"))))
    # within an array, so that the order is made once
    parts = F.flatten(F.transform(F.array(others), lambda o: F.transform(
        F.sequence(F.lit(0), F.ceil(F.size(o) / F.lit(_PART)).cast("int") - 1), lambda b: F.slice(o, b * _PART + 1, F.lit(_PART)))))
    placed = F.transform(parts, lambda p: F.struct(p.alias("p"), F.array_max(F.transform(p, lambda x: x["x"]["end"])).alias("end")))
    near = F.transform(placed, lambda q: F.struct(q["p"].alias("p"), F.filter(
        base, lambda b: (b["start"] < q["end"]) & (F.get(q["p"], F.lit(0))["start"] < b["end"])).alias("base")))
    free = F.transform(near, lambda q: F.filter(q["p"], lambda x: ~F.exists(q["base"], lambda b: _touch(x["x"], b))))
    return F.when(F.exists(found, lambda x: ~x["base"]), F.transform(F.flatten(free), lambda x: x["x"])).otherwise(F.array().cast(_SPANS))


_PLAIN_SPANS = "array<struct<kind:int,start:int,end:int,base:boolean>>"


def _apart(spans: Column) -> Column:
    """Of spans sorted by start, from left to right, those that touch no chosen
    one. Parts of _PART keep long lists from quadratic time."""
    parts = F.transform(F.sequence(F.lit(0), F.ceil(F.size(spans) / F.lit(_PART)).cast("int") - 1),
                        lambda b: F.slice(spans, b * _PART + 1, F.lit(_PART)))

    def step(s: Column, x: Column) -> Column:
        return F.when(x["start"] >= s["at"], F.struct(
            x["end"].alias("at"), F.concat(s["out"], F.array(x)).alias("out"))).otherwise(s)

    def part(s: Column, xs: Column) -> Column:
        done = F.aggregate(xs, F.struct(s["at"].alias("at"), F.array().cast(_PLAIN_SPANS).alias("out")), step)
        return F.struct(done["at"].alias("at"), F.concat(s["out"], F.array(done["out"])).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_PLAIN_SPANS}>").alias("out"))
    return F.when(F.size(spans) > 0, F.flatten(F.aggregate(parts, start, part)["out"])).otherwise(F.array().cast(_PLAIN_SPANS))


def with_spans(docs: DataFrame, judge: Judge | None, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns of ``docs`` (text) and ``spans``: structs of kind
    (by number), start, end and base, sorted by kind, then start.

    Base spans are always there. Others are added where the judge finds them
    likely enough and they touch no span of the base and no added one that
    starts before (at one start, the longer stays). Null and empty texts have no
    spans; each row is on its own.
    """
    checked(carry, {"spans", "found", "exact", "apart", "more"})
    docs = pick(docs, *dict.fromkeys([*carry, "text"]))
    found = with_candidates(docs).withColumn("exact", F.filter("found", lambda x: x["base"]))
    base = F.col("exact")

    def plain(x: Column) -> Column:
        return F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["base"].alias("base"))

    spans = F.transform(base, plain)
    if judge is not None:
        bars = F.array(*map(F.lit, judge.least))

        # features are made once per candidate, then the trees read them
        found = found.withColumn("apart", _free(F.col("found"), base))
        featured = F.transform("apart", lambda x: F.struct(
            x["start"].alias("start"), (-x["end"]).alias("until"), x["kind"].alias("kind"), x["end"].alias("end"),
            x["base"].alias("base"), x["gen"].alias("gen"), _features(x).alias("f")))
        likely = F.filter(featured, lambda x: judge.probability(x["f"]) >= F.element_at(bars, x["gen"] + 1))
        found = found.withColumn("more", F.when(F.size("apart") > 0, F.transform(
            F.array_sort(likely), plain)).otherwise(F.array().cast(_PLAIN_SPANS)))
        spans = F.concat(spans, _apart(F.col("more")))
    return found.withColumn("spans", F.array_sort(spans)).select(*carry, "spans")


def digest(spans: Column, base_only: bool) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    kept = F.filter(spans, lambda x: x["base"]) if base_only else spans
    return F.array_join(F.transform(kept, lambda x: F.concat_ws(
        ":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; of spans that
    overlap, the later one replaces what is left of it."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))

    def step(s: Column, x: Column) -> Column:
        gap = F.substring(text, s["at"] + 1, F.greatest(x["start"] - s["at"], F.lit(0)))
        more = F.struct(x["end"].alias("at"), F.concat(s["out"], gap, F.element_at(names, x["kind"] + 1)).alias("out"))
        return F.when(x["end"] > s["at"], more).otherwise(s)

    done = F.aggregate(ordered, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step)
    return F.when(F.size(spans) == 0, text).otherwise(
        F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))))


def count_of(spans: Column, kind: int) -> Column:
    """The number of base spans of a kind."""
    return F.size(F.filter(spans, lambda x: x["base"] & (x["kind"] == kind))).cast("long")
