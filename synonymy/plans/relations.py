"""Named relations of the analysis, in SQL that Spark and other engines read alike.

A relation is a SELECT that names other relations after FROM or JOIN, and only there
are names read as relations.  The base relations (cds, codon_pos, codon_dim,
foreign_pos) are DataFrames on Spark; the reference SQL has its own text for them.

Relations that many queries read, all of which cost a pass over the sequences, are
*kept*: on Spark they are written once to the shared folder for each state of the
input tables and read from there (``kept=True``).  Where a plan in SQL would gather
rows in one task, a relation has a form of its own for Spark (``on_spark``): other
text, or a function of the relations it needs that returns a DataFrame.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from synonymy.functions import digests
from synonymy.functions.codons import COLUMNS, codon_dim, codon_rows
from synonymy.sources import shared
from synonymy.sources.shared import new_folder, state, written
from synonymy.sources.tables import TABLES, cds_from_documents, codon_positions, table

RELATIONS: dict[str, str] = {}
QUERIES: dict[str, str] = {}
#: Forms of relations and queries on Spark, where they are others than the reference SQL: text or a function.
SPARK: dict[str, str | Callable] = {}
KEPT: set[str] = set()
#: Queries whose reference SQL would not end on whole tables, or that SQL cannot express; tests hold them against brute force.
NO_SQL: set[str] = set()


def relation(name: str, text: str, kept: bool = False) -> None:
    RELATIONS[name] = text
    if kept:
        KEPT.add(name)


def query(name: str, text: str) -> None:
    QUERIES[name] = text


def on_spark(name: str, form: str | Callable) -> None:
    SPARK[name] = form


def spark_query(name: str, form: str | Callable) -> None:
    """A query that only Spark runs."""
    NO_SQL.add(name)
    QUERIES[name] = ""
    SPARK[name] = form


def variant(name: str, new: str, swap: dict[str, str]) -> None:
    """A query that only Spark runs: another one's text, with some relations in place of others all the way down."""

    def copied(relation_: str) -> str:
        if relation_ in swap:
            return swap[relation_]
        text = SPARK.get(relation_) or RELATIONS.get(relation_)
        return relation_ if not isinstance(text, str) else placed(relation_, text, f"{relation_}_for_{new}")

    def placed(old: str, text: str, name_: str) -> str:
        other = _NAMED.sub(lambda m: f"{m[1]}{m[2]}{copied(m[3])}" + ("" if _aliased(text, m.end()) or copied(m[3]) == m[3] else f" AS {m[3]}"), text)
        if other == text:
            return old
        SPARK[name_] = other
        if old in KEPT:
            KEPT.add(name_)
        return name_

    text = SPARK.get(name) or QUERIES[name]
    placed(name, text, new)
    spark_query(new, SPARK[new])


def _values() -> str:
    show = lambda x: f"'{x}'" if isinstance(x, str) else str(x).upper() if isinstance(x, bool) else str(x)
    return ", ".join("(" + ", ".join(map(show, r)) + ")" for r in codon_rows())


#: Text of the base relations for engines that have no DataFrames.
BASE = {
    "codon_dim": f"SELECT * FROM (VALUES {_values()}) AS t({', '.join(COLUMNS)})",
    "cds": """SELECT * FROM (SELECT doc_id AS gene, source || '-' || lang AS sample_id, source AS genome, lang AS cond, upper(regexp_replace(text, '[^ACGTacgt]', '', 'g')) AS seq,
        length(regexp_replace(text, '[^ACGTacgt]', '', 'g')) AS length FROM documents) WHERE length >= 240""",
    "codon_pos": """SELECT gene, sample_id, genome, cond, p AS pos, substr(translate(seq, 'T', 'U'), 3 * p - 2, 3) AS codon FROM (SELECT *, unnest(range(1, length // 3 + 1)) AS p FROM cds)""",
    "foreign_pos": """SELECT gene, p AS pos, substr(s, 3 * p - 2, 3) AS codon FROM (SELECT item_id AS gene, translate(upper(regexp_replace(text, '[^ACGTacgt]', '', 'g')), 'T', 'U') AS s,
        unnest(range(1, length(regexp_replace(text, '[^ACGTacgt]', '', 'g')) // 3 + 1)) AS p FROM benchmark)""",
}
BASE_TABLE = {"cds": "documents", "codon_pos": "documents", "foreign_pos": "benchmark", "codon_dim": None}
_NAMED = re.compile(r"\b(FROM|JOIN)(\s+)([A-Za-z_]\w*)")


def names(text: str) -> list[str]:
    """Relations and tables that a text reads, in order, once."""
    return list(dict.fromkeys(m[3] for m in _NAMED.finditer(text)))


def _with(text: str, every: dict[str, str]) -> str:
    """The text after the relations it needs, as common table expressions; one may shadow a table, not itself."""
    placed: dict[str, str] = {}

    def place(part: str, inside: tuple) -> None:
        for name in names(part):
            if name in every and name not in placed and name not in inside:
                place(every[name], (*inside, name))
                placed[name] = every[name]

    place(text, ())
    return ("WITH " + ",\n".join(f"{n} AS ({t})" for n, t in placed.items()) + "\n" if placed else "") + text


def reference_sql(name: str) -> str:
    return re.sub(r"\bpercentile\(", "quantile_cont(", _with(QUERIES[name], BASE | RELATIONS))


class Run:
    """Relations over one folder of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def _base(self, name: str) -> DataFrame:
        if name == "codon_dim":
            return codon_dim(self.spark)
        if name == "foreign_pos":
            items = table(self.spark, self.sf_dir, "benchmark").selectExpr("item_id AS gene", "upper(regexp_replace(text, '[^ACGTacgt]', '')) AS seq")
            return codon_positions(items, "gene")
        cds = cds_from_documents(table(self.spark, self.sf_dir, "documents"))
        return cds if name == "cds" else codon_positions(cds, "gene", "sample_id", "genome", "cond")

    def _form(self, name: str):
        return SPARK.get(name) or RELATIONS.get(name) or QUERIES.get(name)

    def _trace(self, name: str, seen: dict[str, str]) -> dict[str, str]:
        """The forms of all that a relation rests on; a function's are those that it lists in ``needs``."""
        form = self._form(name)
        if name in seen or (form is None and name not in BASE_TABLE and name not in TABLES):
            return seen
        seen[name] = form if isinstance(form, str) else getattr(form, "__name__", repr(form))
        for part in names(form) if isinstance(form, str) else form.needs if form else [BASE_TABLE[name]] if BASE_TABLE.get(name) else []:
            self._trace(part, seen)
        return seen

    def __call__(self, name: str) -> DataFrame:
        """A relation, query or table as a DataFrame."""
        if name in KEPT:
            rests = self._trace(name, {})
            tables = tuple((t, state(self.spark, f"{self.sf_dir}/{t}.parquet")) for t in sorted(rests.keys() & set(TABLES)))
            key = (self.spark.sparkContext.applicationId, self.sf_dir, name, tuple(rests.items()), tables)
            if key not in _WRITTEN:
                _WRITTEN[key] = written(self._fresh(name), f"{new_folder(self.spark, 'usage')}/{name}")
            return _WRITTEN[key]
        return self._fresh(name)

    def _fresh(self, name: str) -> DataFrame:
        form = self._form(name)
        if form is None:
            return self._base(name) if name in BASE else table(self.spark, self.sf_dir, name)
        return self.sql(form) if isinstance(form, str) else form(self)

    def sql(self, text: str, **frames: DataFrame) -> DataFrame:
        """Run a text; kept and base relations, tables and the given frames are DataFrames, other relations go before it."""
        own = {n: t for n, t in (RELATIONS | {k: v for k, v in SPARK.items() if k not in QUERIES}).items() if n not in KEPT and n not in frames and isinstance(t, str)}
        whole = _with(text, own)
        inside = set(own) & set(names(whole))
        used = [n for n in names(whole) if n not in inside and (n in frames or n in KEPT or n in SPARK or n in BASE or n in TABLES)]
        whole = _NAMED.sub(lambda m: f"{m[1]}{m[2]}{{{m[3]}}} AS {m[3]}" if m[3] in used and not _aliased(whole, m.end()) else f"{m[1]}{m[2]}{{{m[3]}}}" if m[3] in used else m[0], whole)
        if "words_below(" in whole:
            digests.register(self.spark)
        return self.spark.sql(whole, **{n: frames.get(n) if n in frames else self(n) for n in used})


_CLAUSES = {"where", "join", "left", "right", "full", "inner", "cross", "on", "using", "group", "order", "union", "intersect", "except", "having", "limit", "natural"}
_WRITTEN: dict[tuple, DataFrame] = {}


def _aliased(text: str, at: int) -> bool:
    """Whether a table's name that ends here is followed by an alias."""
    m = re.match(r"\s+(?:AS\s+)?([A-Za-z_]\w*)", text[at:])
    return bool(m) and m[1].lower() not in _CLAUSES


def needs(*relations: str):
    """Marks what a function form reads."""

    def mark(f):
        f.needs = relations
        return f

    return mark


def run(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return Run(spark, sf_dir)(name)


def clear(spark: SparkSession) -> None:
    """Delete the kept relations and all other scratch of this process; results read before are gone."""
    _WRITTEN.clear()
    shared.clear(spark)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: partial(_run, name=name) for name in QUERIES}


def _run(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return run(spark, sf_dir, name)
