"""CSV and Parquet tables, JSON reports."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from evenkeel.functions.columns import NUMBER, as_number, exprs, quote, quotes, text
from evenkeel.sources.shared import materialize, write_scratch
from evenkeel.spec import EmptyInputError, ValidationError

# Cell texts that mean "missing".
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
# Encoding names that the JVM does not know.
CHARSETS = {"latin1": "ISO-8859-1", "latin-1": "ISO-8859-1", "utf8": "UTF-8"}
# Cell texts that mean true and false.
TRUTHS = ("True", "TRUE", "true", "False", "FALSE", "false")

_CORRUPT = "_corrupt_record"


def _csv_options(sep: str, encoding: str, multiline: bool) -> dict:
    return {
        "header": True,
        "sep": sep,
        "encoding": CHARSETS.get(encoding.lower(), encoding),
        "quote": '"',
        "escape": '"',
        "multiLine": multiline,
        "mode": "PERMISSIVE",
    }


def _header(spark: SparkSession, path: str, options: Mapping) -> list[str]:
    names = spark.read.options(**options).csv(path).columns
    if not names:
        raise EmptyInputError(f"{path} is empty: it has not even a header")
    return names


def csv_columns(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8") -> list[str]:
    """The header of a CSV file."""
    return _header(spark, path, _csv_options(sep, encoding, False))


def read_csv(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    encoding: str = "UTF-8",
    schema: T.StructType | None = None,
    na_values: Iterable[str] = MISSING_TOKENS,
    multiline: bool = False,
) -> DataFrame:
    """Delimited text with a header.

    Cells are read as text, missing tokens become null, then columns get
    their types: from ``schema`` by name (cells that do not fit become null),
    else from one pass over the text. ``multiline`` allows line breaks inside
    quotes, at the price of files that cannot be read in parallel parts.
    """
    na_values = tuple(na_values)
    options = _csv_options(sep, encoding, multiline)
    names = _header(spark, path, options)
    cells = T.StructType([T.StructField(n, T.StringType()) for n in names])
    # enforceSchema=False makes Spark compare the header of every file
    raw = spark.read.schema(cells).options(**options, enforceSchema=False).csv(path)
    raw = raw.selectExpr(*[f"{_filled(n, na_values)} AS {quote(n)}" for n in names])
    if schema is None:
        schema = infer_types(raw)
    else:
        absent = [f.name for f in schema.fields if f.name not in names]
        if absent:
            raise ValidationError(f"missing columns {absent}; found {names}")
    return raw.selectExpr(*[f"{_typed(quote(f.name), f.dataType)} AS {quote(f.name)}" for f in schema.fields])


def _filled(name: str, na_values: Iterable[str]) -> str:
    """SQL text: the cell, or null where its text means "missing"."""
    c = quote(name)
    if not na_values:
        return c
    return f"CASE WHEN {c} NOT IN ({', '.join(text(v) for v in na_values)}) THEN {c} END"


def _typed(value: str, kind: T.DataType) -> str:
    if isinstance(kind, T.StringType):
        return value
    if isinstance(kind, (T.FloatType, T.DoubleType)):  # no suffixes, no hexadecimal
        return f"CAST({as_number(value, T.StringType())} AS {kind.simpleString()})"
    return f"try_cast(trim({value}) AS {kind.simpleString()})"


def infer_types(df: DataFrame) -> T.StructType:
    """Types of text columns, from one aggregate over the table."""
    checks = []
    for i, c in enumerate(quotes(df.columns)):
        truths = ", ".join(text(t) for t in TRUTHS)
        checks += [
            f"count({c}) AS n{i}",
            f"count_if({c} RLIKE r'^\\s*[+-]?\\d+\\s*$' AND try_cast(trim({c}) AS bigint) IS NOT NULL) AS i{i}",
            f"count_if({c} RLIKE r'{NUMBER}') AS f{i}",
            f"count_if({c} IN ({truths})) AS b{i}",
        ]
    seen = df.agg(*exprs(checks)).first()
    fields = []
    for i, name in enumerate(df.columns):
        n = seen[f"n{i}"]
        if n == 0:
            kind = T.DoubleType()
        elif seen[f"i{i}"] == n:
            kind = T.LongType()
        elif seen[f"f{i}"] == n:
            kind = T.DoubleType()
        elif seen[f"b{i}"] == n:
            kind = T.BooleanType()
        else:
            kind = T.StringType()
        fields.append(T.StructField(name, kind))
    return T.StructType(fields)


def _misfits(schema: T.StructType, na_values: Iterable[str]) -> str:
    """SQL text: the columns whose cells are neither missing nor of the type."""
    found = []
    for f in schema.fields:
        if not isinstance(f.dataType, T.StringType):
            cell = _filled(f.name, na_values)
            found.append(f"CASE WHEN ({cell}) IS NOT NULL AND {_typed(cell, f.dataType)} IS NULL THEN {text(f.name)} END")
    return f"array_compact(CAST(array({', '.join(found)}) AS array<string>))"


def _cells_of_line(sep: str, n: int) -> str:
    """SQL text: how many cells a line has that has not ``n``, else n."""
    bare = f"""regexp_replace({_CORRUPT}, r'"([^"]|"")*"', '')"""
    return f"coalesce(length({bare}) - length(replace({bare}, {text(sep)}, '')) + 1, {n})"


def _kind(n: int) -> str:
    return f"CASE WHEN {_CORRUPT} IS NULL THEN 'value' WHEN n_cells > {n} THEN 'long' ELSE 'short' END"


def _line(names: Iterable[str], sep: str) -> str:
    return f"coalesce({_CORRUPT}, to_csv(struct({', '.join(quotes(names))}), map('sep', {text(sep)})))"


def malformed_rows(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str = ",",
    encoding: str = "UTF-8",
    na_values: Iterable[str] = MISSING_TOKENS,
) -> DataFrame:
    """The lines of a CSV file that do not fit ``schema``, with the reason:
    ``long`` (too many cells), ``short`` (too few) or ``value`` (the cells of
    ``bad_columns`` are neither missing nor of the column's type).

    The lines found are written to the shared folder first: Spark answers no
    query on a CSV file that needs the raw line alone.
    """
    na_values = tuple(na_values)
    names = [f.name for f in schema.fields]
    wide = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _CORRUPT]])
    options = _csv_options(sep, encoding, False)
    parsed = spark.read.schema(wide).options(**options, columnNameOfCorruptRecord=_CORRUPT).csv(path)
    found = parsed.selectExpr("*", f"{_misfits(schema, na_values)} AS __bad").filter(f"{_CORRUPT} IS NOT NULL OR size(__bad) > 0")
    found = materialize(found, "malformed")
    return found.selectExpr("*", f"{_cells_of_line(sep, len(names))} AS n_cells").selectExpr(
        f"{_kind(len(names))} AS kind",
        "n_cells",
        f"{len(names)} AS n_expected",
        f"CASE WHEN {_CORRUPT} IS NULL THEN __bad END AS bad_columns",
        f"{_line(names, sep)} AS line",
    )


@dataclass(frozen=True)
class Landing:
    """A CSV file after its one parse, both outputs read from the same copy."""

    rows: DataFrame
    bad: DataFrame
    counts: Mapping[str, int] = field(default_factory=dict)
    path: str = ""


def land_csv(
    spark: SparkSession,
    path: str,
    to: str | None = None,
    sep: str = ",",
    encoding: str = "UTF-8",
    schema: T.StructType | None = None,
    na_values: Iterable[str] = MISSING_TOKENS,
) -> Landing:
    """Parse a CSV file once and keep the result as Parquet under ``to``, or in
    the shared folder without one.

    ``rows`` are all lines with their types, as ``read_csv`` gives them: cells
    that do not fit are null. ``bad`` are the lines that do not fit, as
    ``malformed_rows`` gives them, so that both can be looked at without another
    parse. ``counts`` come with the write: ``n_rows``, ``bad:short``,
    ``bad:long``, ``bad:unreadable`` (cells of the wrong type) and
    ``suspect:<column>`` (wrongly decoded text). Without a ``schema`` the copy
    holds text, and types are inferred from it.
    """
    na_values = tuple(na_values)
    options = _csv_options(sep, encoding, False)
    names = _header(spark, path, options)
    if schema is not None and (absent := [f.name for f in schema.fields if f.name not in names]):
        raise ValidationError(f"missing columns {absent}; found {names}")
    wide = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _CORRUPT]])
    raw = spark.read.schema(wide).options(
        **options, columnNameOfCorruptRecord=_CORRUPT, enforceSchema=False).csv(path)
    wanted = schema or T.StructType([T.StructField(n, T.StringType()) for n in names])
    cells = [f"{_typed(f'({_filled(f.name, na_values)})', f.dataType)} AS {quote(f.name)}" for f in wanted.fields]
    marked = raw.selectExpr("*", f"{_misfits(wanted, na_values)} AS __bad", f"{_cells_of_line(sep, len(names))} AS n_cells")
    misfit = f"({_CORRUPT} IS NOT NULL OR size(__bad) > 0)"
    told = marked.selectExpr(
        *cells, f"CASE WHEN {misfit} THEN {_kind(len(names))} END AS __kind", "n_cells AS __n_cells",
        f"CASE WHEN {_CORRUPT} IS NULL THEN __bad END AS __bad_columns",
        f"CASE WHEN {misfit} THEN {_line(names, sep)} END AS __line")
    seen = Observation()
    texts = [f.name for f in wanted.fields if isinstance(f.dataType, T.StringType)]
    told = told.observe(seen, *exprs([
        "count(1) AS n_rows",
        *[f"count_if(__kind = '{k}') AS {k}" for k in ("short", "long", "value")],
        *[f"count_if(contains({quote(c)}, '\ufffd')) AS s{i}" for i, c in enumerate(texts)]]))
    if to is None:
        to = write_scratch(told, "landing")
    else:
        told.write.mode("overwrite").parquet(to)
    found = seen.get
    copy = spark.read.schema(told.schema).parquet(to)
    rows = copy.selectExpr(*quotes(f.name for f in wanted.fields))
    if schema is None:
        kinds = infer_types(rows)
        rows = rows.selectExpr(*[f"{_typed(quote(f.name), f.dataType)} AS {quote(f.name)}" for f in kinds.fields])
    bad = copy.filter("__kind IS NOT NULL").selectExpr(
        "__kind AS kind", "__n_cells AS n_cells", f"{len(names)} AS n_expected", "__bad_columns AS bad_columns", "__line AS line")
    counts = {"n_rows": found["n_rows"], "bad:short": found["short"], "bad:long": found["long"], "bad:unreadable": found["value"],
              **{f"suspect:{c}": found[f"s{i}"] for i, c in enumerate(texts)}}
    return Landing(rows, bad, counts, to)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", sep: str = ",", encoding: str = "UTF-8") -> None:
    """Save a table as Parquet or CSV, replacing what is there; ``sep`` and
    ``encoding`` are for CSV."""
    if fmt == "parquet":
        df.write.mode("overwrite").parquet(path)
    elif fmt == "csv":
        options = {k: v for k, v in _csv_options(sep, encoding, False).items() if k not in ("multiLine", "mode")}
        df.write.mode("overwrite").options(**options).csv(path)
    else:
        raise ValidationError(f"unsupported output format: {fmt}")


@dataclass(frozen=True)
class GroupReport:
    """A report on any number of groups: one summary row, a table of groups."""

    summary: DataFrame
    groups: DataFrame
    keys: tuple[str, ...]


def write_report(report: DataFrame | GroupReport, path: str) -> None:
    """Save a report as one JSON document, missing values written as null.

    A ``GroupReport`` becomes the document ``summary`` and the folder ``groups``:
    one JSON line per group, in order of the keys from file to file, written by
    as many tasks as there are ranges of keys.
    """
    if isinstance(report, GroupReport):
        ordered = report.groups.orderBy(*[quote(k) for k in report.keys])
        ordered.write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/groups")
        report, path = report.summary, f"{path}/summary"
    report.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def _write_labelled(labelled: DataFrame, names: Iterable[str], path: str, fmt: str) -> list[str]:
    """All splits in one pass, to folders ``split=<name>``; counts come along."""
    seen = Observation()
    counted = labelled.observe(seen, *exprs(["count(1) AS n", *[f"count_if(split = {text(n)}) AS {quote(n)}" for n in names]]))
    out = counted.write.mode("overwrite").partitionBy("split")
    if fmt == "parquet":
        out.parquet(path)
    elif fmt == "csv":
        out.options(**_csv_options(",", "UTF-8", False)).csv(path)
    else:
        raise ValidationError(f"unsupported output format: {fmt}")
    return [n for n in names if seen.get[n]]


def write_splits(splits, paths: str | Mapping[str, str], fmt: str = "parquet") -> list[str]:
    """Save splits; empty ones are skipped. Returns the names of those written.

    With one path, all splits (of ``train_val_test_split``, or a mapping of
    names to tables) are written in one pass over the table, to folders
    ``split=<name>`` under it. With a path per split, each is written there.
    """
    frames = dict(splits.items())
    if isinstance(paths, str):
        labelled = getattr(splits, "labelled", None)
        if labelled is None:
            for name, frame in frames.items():
                if "split" in frame.columns:
                    raise ValidationError("a column is called split; give a path per split")
                part = frame.selectExpr("*", f"{text(name)} AS split")
                labelled = part if labelled is None else labelled.unionByName(part)
        return _write_labelled(labelled, list(frames), paths, fmt)
    written = []
    for name, frame in frames.items():
        if frame.isEmpty():
            continue
        write_table(frame, paths[name], fmt)
        written.append(name)
    return written
