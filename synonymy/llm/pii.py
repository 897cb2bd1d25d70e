"""Personal data by weak supervision, with DataFrame functions only.

Patterns propose candidate spans.  Three labelers vote on each: its strict form
(regex), lists of known values (gazetteer) and the words before it (context).
Expectation-maximisation estimates each labeler's reliability from the counts of
vote patterns; its posteriors are the soft labels of a naive Bayes span classifier
on surface features, which decides on the candidates that the base rules leave
open.  Spans of the base rules always stay.

The text is scanned once; what follows works on the candidates, and on tables whose
size is bounded by the number of kinds, votes and bins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, only, scratch

KINDS = ("email", "ip", "card", "phone")
EM_ROUNDS = 25
ACCEPT = 0.5

#: Base patterns.  Runs are possessive and start only where a run starts (or where the last match ended), which finds the
#: same leftmost non-overlapping matches as the plain patterns, in time linear in the text.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Candidates that no base rule covers: spelled-out addresses, 13-digit card numbers, phone numbers without a country code.
MORE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:\[at\]|\(at\))\x20?[A-Za-z0-9-]++\x20?(?:\.|\[dot\]|\(dot\))\x20?[A-Za-z]{2,}+",
    "card": r"(?<![0-9][\x20-]?)(?<![0-9])[0-9](?:[\x20-]?[0-9]){12}(?![\x20-]?[0-9])",
    "phone": r"(?<!\+[0-9]{1,3}[\x20.-]?)(?<![0-9(])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
#: Fixed values of the labelers.
TOP_LEVEL = "com org net edu gov mil int io de fr es it uk eu us ca au nl ch at be pl se no dk fi ru cn jp kr in br mx info biz dev app co"
CALLING_CODES = r"^\+?(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|2[1-689][0-9]|3[578][0-9]|42[0-9]|5[09][0-9]|6[7-9][0-9]|8[057][0-9]|9[679][0-9])"
CARD_PREFIX = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35|30[0-5]|36|38)"
BEFORE = {
    "email": r"(?:e-?mail|mail|contact|correo|courriel|@|write to|reach)\W*$",
    "ip": r"(?:\bip\b|addr|address|host|server|client|adresse|from)\W*$",
    "card": r"(?:card|visa|master|amex|credit|karte|carte|tarjeta|pan)\W*(?:no|number|nr)?\W*$",
    "phone": r"(?:tel|phone|call|mobile|fax|cell|telefon|tél|whatsapp)\W*(?:no|number|nr)?\W*$",
}
NOT_BEFORE = r"(?:version|\bv|release|build|order|invoice|isbn|sku|serial|id|no|ref|page|section|chapter)\W*$"


#: Matches that are appended one by one; a text with more goes in blocks, so that its cost stays near its length.
BLOCK = 64


def found(text: Column, pattern: str, kind: int, base: bool) -> Column:
    """Array of (start, kind, end, base, match, before) of the pattern's matches, in code points."""
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"))
    none = F.expr("cast(array() as array<struct<start:bigint,kind:int,end:bigint,base:boolean,match:string,before:string>>)")
    width = lambda x: (F.length(x["gap"]) + F.coalesce(F.length(x["match"]), F.lit(0))).cast("long")

    def step(acc, x):
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["match"])
        span = F.struct(start.cast("long").alias("start"), F.lit(kind).alias("kind"), end.cast("long").alias("end"), F.lit(base).alias("base"), x["match"].alias("match"), F.lower(F.right(x["gap"], F.lit(32))).alias("before"))
        return F.when(x["match"].isNull(), acc).otherwise(F.struct(end.cast("long").alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans")))

    def spans_from(at, some):
        return F.aggregate(some, F.struct(at.cast("long").alias("at"), none.alias("spans")), step)["spans"]

    def blocked(parts):
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / BLOCK).cast("int")), lambda b: F.slice(parts, b * BLOCK + 1, F.lit(BLOCK)))
        sizes = F.transform(blocks, lambda blk: F.aggregate(blk, F.lit(0).cast("long"), lambda n, x: n + width(x)))
        begins = F.aggregate(sizes, F.array(F.lit(0).cast("long")), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
        return F.flatten(F.transform(F.arrays_zip(blocks.alias("blk"), F.slice(begins, 1, F.size(blocks)).alias("at")), lambda z: spans_from(z["at"], z["blk"])))

    # A lambda's variable, so that the pattern is sought once.
    either = F.transform(F.array(parts), lambda p: F.when(F.size(p) <= BLOCK, spans_from(F.lit(0), p)).otherwise(blocked(p)))
    return F.get(either, F.lit(0))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def value(c, i):
        d = F.coalesce(c.try_cast("int"), F.lit(0)) * F.when(i % 2 == 1, 2).otherwise(1)
        return d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), value), F.lit(0), lambda a, x: a + x) % 10 == 0


def _holds(kind: str, m: Column) -> Column:
    """The base rule on a match."""
    n = F.length(_digits(m))
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = lambda p: F.ltrim(p, F.lit("0"))
        return F.forall(F.split(m, r"\."), lambda p: (F.length(part(p)) < 3) | ((F.length(part(p)) == 3) & (part(p) <= "255")))
    if kind == "card":
        return n.between(14, 19) & _luhn(_digits(m))
    return n.between(10, 15)


def _kept(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: _holds(kind, s["match"]))


def _of_kind(spans: str, i: int) -> Column:
    return F.filter(spans, lambda s: s["kind"] == i)


def candidates(text: Column) -> Column:
    """All candidate spans of a text with three votes (1, 0, -1: none) and the bins of surface features."""
    text = F.coalesce(text, F.lit(""))
    sign = {"email": "@", "phone": "+", "ip": "."}
    none = F.expr("cast(array() as array<struct<start:bigint,kind:int,end:bigint,base:boolean,match:string,before:string>>)")
    arrays = []
    for i, kind in enumerate(KINDS):
        spans = _kept(found(text, BASE[kind], i, True), kind)
        arrays.append(F.when(F.contains(text, F.lit(sign[kind])), spans).otherwise(none) if kind in sign else spans)
    for i, kind in enumerate(KINDS):
        if kind in MORE:
            spans = found(text, MORE[kind], i, False)
            arrays.append(F.when(F.contains(F.lower(text), F.lit("at")) & F.rlike(text, F.lit(r"(?i)[\[(]at[\])]")), spans).otherwise(none) if kind == "email" else spans)
    every = F.concat(*arrays)

    def voted(s):
        m, kind, before = s["match"], s["kind"], s["before"]
        pick = lambda options: F.coalesce(*[F.when(kind == i, o) for i, o in enumerate(options)])
        yes = lambda c: F.when(c, 1).otherwise(0)
        tld = F.array_contains(F.split(F.lit(TOP_LEVEL), " "), F.lower(F.regexp_extract(m, r"([A-Za-z]+)$", 1)))
        octet = F.regexp_extract(m, "^0*([0-9]{1,3})", 1).try_cast("int")
        known = pick([yes(tld), F.when(octet.between(1, 223), 1).otherwise(0), yes(F.rlike(_digits(m), F.lit(CARD_PREFIX))), yes(F.rlike(_digits(m), F.lit(CALLING_CODES)))])
        near = pick([F.when(F.rlike(before, F.lit(BEFORE[k])), 1).when(F.rlike(before, F.lit(NOT_BEFORE)), 0).otherwise(-1) for k in KINDS])
        strict = pick([yes(s["base"]), yes(s["base"]), yes(_luhn(_digits(m))), yes(s["base"] | F.rlike(m, F.lit(r"^\(")))])
        length = F.least(F.length(m), F.lit(31)).cast("int")
        signs = F.least(F.length(F.regexp_replace(m, "[0-9A-Za-z]", "")), F.lit(7)).cast("int")
        last = F.when(before == "", "start").when(F.rlike(before, F.lit(r"\n$")), "line").when(F.rlike(before, F.lit(r"[\x20\t]$")), "space").when(F.rlike(before, F.lit(r"[0-9A-Za-z]$")), "word").otherwise("sign")
        return F.struct(
            s["start"].alias("start"), kind.alias("kind"), s["end"].alias("end"), s["base"].alias("base"),
            strict.cast("int").alias("v1"), known.cast("int").alias("v2"), near.cast("int").alias("v3"),
            F.array(F.concat(F.lit("length"), length.cast("string")), F.concat(F.lit("signs"), signs.cast("string")), F.concat(F.lit("before-"), last)).alias("bins"),
        )

    return F.transform(every, voted)


def reliabilities(cands: DataFrame) -> DataFrame:
    """kind, v1, v2, v3, n, posterior: EM for two classes and three independent labelers that may abstain.

    ``cands`` has kind, v1, v2, v3.  Vote patterns are counted first (27 a kind at
    most); all rounds are one fold over the array of a kind's patterns.
    """
    counts = cands.groupBy("kind", "v1", "v2", "v3").agg(F.count("*").alias("n"))
    table = counts.groupBy("kind").agg(F.array_sort(F.collect_list(F.struct("v1", "v2", "v3", F.col("n").cast("double").alias("n")))).alias("patterns"))

    def likelihood(x, th, c):
        out = th[f"p{c}"]
        for k in (1, 2, 3):
            out = out * F.when(x[f"v{k}"] == 1, th[f"r{k}{c}"]).when(x[f"v{k}"] == 0, 1 - th[f"r{k}{c}"]).otherwise(1.0)
        return out

    def posterior(x, th):
        one, zero = likelihood(x, th, 1), likelihood(x, th, 0)
        return one / (one + zero)

    names = [f"{s}{k}{c}" for s in ("y", "s") for k in (1, 2, 3) for c in (0, 1)]

    def summed(patterns, th):
        zero = F.struct(*[F.lit(0.0).alias(n) for n in ("t0", "t1", *names)])

        def add(acc, x):
            q = posterior(x, th)
            w = {1: x["n"] * q, 0: x["n"] * (1 - q)}
            out = [(acc[f"t{c}"] + w[c]).alias(f"t{c}") for c in (0, 1)]
            for n in names:
                k, c = n[1], int(n[2])
                hit = (x[f"v{k}"] == 1) if n[0] == "y" else (x[f"v{k}"] >= 0)
                out.append((acc[n] + F.when(hit, w[c]).otherwise(0.0)).alias(n))
            return F.struct(*out)

        def renewed(t):
            # A Beta prior says that a labeler votes 1 on true spans rather than on false ones.
            r = [((t[f"y{k}{c}"] + (4.0 if c else 1.0)) / (t[f"s{k}{c}"] + 5.0)).alias(f"r{k}{c}") for k in (1, 2, 3) for c in (0, 1)]
            total = t["t0"] + t["t1"] + 2.0
            return F.struct(((t["t0"] + 1.0) / total).alias("p0"), ((t["t1"] + 1.0) / total).alias("p1"), *r)

        return F.aggregate(patterns, zero, add, renewed)

    start = F.struct(F.lit(0.5).alias("p0"), F.lit(0.5).alias("p1"), *[F.lit(0.8 if c else 0.2).alias(f"r{k}{c}") for k in (1, 2, 3) for c in (0, 1)])
    fitted = table.select("kind", "patterns", F.aggregate(F.sequence(F.lit(1), F.lit(EM_ROUNDS)), start, lambda th, _: summed(F.col("patterns"), th)).alias("th"))
    return fitted.select("kind", "th", F.explode("patterns").alias("x")).select("kind", "x.v1", "x.v2", "x.v3", F.col("x.n").alias("n"), posterior(F.col("x"), F.col("th")).alias("posterior"))


def classifier(cands: DataFrame, votes: DataFrame) -> DataFrame:
    """kind, bin, weight: naive Bayes log odds of each surface feature, from soft labels; bin '' is the prior."""
    soft = cands.join(F.broadcast(votes.select("kind", "v1", "v2", "v3", "posterior")), ["kind", "v1", "v2", "v3"])  # at most 108 rows
    bins = soft.select("kind", F.explode(F.concat(F.array(F.lit("")), "bins")).alias("bin"), "posterior")
    sums = bins.groupBy("kind", "bin").agg(F.sum("posterior").alias("one"), F.sum(1 - F.col("posterior")).alias("zero"))
    prior = sums.where("bin = ''").select("kind", F.col("one").alias("all_one"), F.col("zero").alias("all_zero"))
    odds = F.log((F.col("one") + 0.5) / (F.col("zero") + 0.5))
    base = F.log((F.col("all_one") + 0.5) / (F.col("all_zero") + 0.5))
    return sums.join(F.broadcast(prior), "kind").select("kind", "bin", F.when(F.col("bin") == "", odds).otherwise(odds - base).alias("weight"))


def _lookup(rows, key, value) -> Column:
    """A literal map of a bounded table."""
    flat = [F.lit(x) for r in rows for x in (key(r), float(value(r)))]
    return F.create_map(*flat) if flat else F.expr("map('', 0.0D)")


def spans(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` with arrays base and added of (start, kind, end), by start and kind."""
    folder = scratch(docs.sparkSession)
    rows = only(docs, *dict.fromkeys([*keep, "text"]))
    table = cut(rows.select(*[F.col(f"`{c}`").alias(f"keep{i}") for i, c in enumerate(keep)], candidates(F.col("text")).alias("cands")), folder, "candidates")
    cands = table.where(F.size("cands") > 0).select(F.explode("cands").alias("c")).select("c.kind", "c.v1", "c.v2", "c.v3", "c.bins")
    votes = cut(reliabilities(cands), folder, "votes")
    post = votes.collect()  # at most 27 rows a kind
    weights = classifier(cands, votes).collect()  # at most 46 rows a kind
    posterior = _lookup(post, lambda r: f"{r['kind']}:{r['v1']}:{r['v2']}:{r['v3']}", lambda r: r["posterior"])
    weight = _lookup(weights, lambda r: f"{r['kind']}:{r['bin']}", lambda r: r["weight"])

    def score(c):
        p = F.coalesce(F.try_element_at(posterior, F.concat_ws(":", c["kind"], c["v1"], c["v2"], c["v3"])), F.lit(0.5))
        p = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
        surface = F.aggregate(c["bins"], F.lit(0.0), lambda a, b: a + F.coalesce(F.try_element_at(weight, F.concat(c["kind"].cast("string"), F.lit(":"), b)), F.lit(0.0)))
        return F.log(p / (1 - p)) + surface

    threshold = F.log(F.lit(ACCEPT / (1 - ACCEPT)))
    base = F.filter("cands", lambda c: c["base"])
    # Only candidates that no base rule covers need a score, and only documents that have some.
    open_ = F.filter("cands", lambda c: ~c["base"] & ~F.exists(F.filter("cands", lambda x: x["base"]), lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    added = F.filter(open_, lambda c: score(c) >= threshold)
    plain = lambda a: F.array_sort(F.array_distinct(F.transform(a, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))))
    none = F.filter("cands", lambda c: F.lit(False))
    found_ = F.when(F.exists("cands", lambda c: ~c["base"]), added).otherwise(none)
    return table.select(*[F.col(f"keep{i}").alias(c) for i, c in enumerate(keep)], plain(base).alias("base"), plain(found_).alias("added"))


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added for each row of ``docs`` (doc_id, text).

    ``spans`` lists kind:start:end (code points, end exclusive) by start, then kind; the
    counts and base_sha256 are those of the base rules.  A null or empty text has no
    spans.  Null and repeated doc_ids are kept row by row.  Added spans never
    overlap base ones.  Columns other than doc_id and text are ignored.
    """
    name = F.array(*map(F.lit, KINDS))
    joined = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"], s["end"])), ",")
    counts = [F.size(_of_kind("base", i)).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    every = F.array_sort(F.concat("base", "added"))
    return spans(docs, ["doc_id"]).select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(every).alias("spans"), F.size("added").cast("long").alias("n_added"))


def redacted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with each span of ``find`` replaced by its kind, as in [EMAIL]; n_chars, if there, follows.

    Spans that overlap are one, under the name of the first.
    """
    keep = docs.columns
    table = spans(docs, keep)
    mark = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def step(acc, s):
        out = F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int")), F.get(mark, s["kind"]))
        fresh = s["start"] >= acc["at"]
        return F.struct(F.greatest(acc["at"], s["end"].cast("int")).alias("at"), F.when(fresh, out).otherwise(acc["out"]).alias("out"))

    every = F.array_sort(F.concat("base", "added"))
    whole = F.aggregate(every, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    out = table.withColumn("text", F.when(F.size(every) > 0, whole).otherwise(F.col("text")))
    if "n_chars" in keep:
        out = out.withColumn("n_chars", F.when(F.size(every) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*keep)


def op2_pii(spark, sf_dir):
    return find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
