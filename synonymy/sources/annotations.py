"""Annotation sources and sinks: gene positions, tRNA genes, pathway bridges, marker ids, and annotated GFF and FASTA files.

Files are read as lines or records by Spark; small files of ids, names or maps are tables too.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from synonymy.functions.codons import codon_dim, reverse_complement
from synonymy.operators.ranking import ordered
from synonymy.sources.tables import read_fasta, read_ids, table  # noqa: F401

#: Attributes that may hold a gene's id, by priority, and prefixes that files put before ids.
ID_ATTRIBUTES = ("Name", "locus_tag", "protein_id", "ID", "Parent")
ID_PREFIXES = ("cds-", "gene-", "rna-", "mrna-", "CDS:", "gene:", "cds_", "gene_")
#: Where a tRNA's anticodon lies in its gene (from 0), and how far it may be off.
ANTICODON_AT, ANTICODON_OFF = 33, 4
#: Wobble weights by the anticodon's first base and the codon's third.
WOBBLE = (("U", "A", 1.0), ("U", "G", 0.561), ("C", "G", 1.0), ("G", "C", 1.0), ("G", "U", 0.561), ("A", "U", 0.9999), ("A", "C", 0.72), ("A", "A", 0.32))
RIBOSOMAL_NAME = r"(?i)\brp[slm][a-z]?\b|ribosomal protein"


# ---------------------------------------------------------------- columns and ids
def first_column(df: DataFrame, candidates: tuple[str, ...], fall_back: bool = False) -> str | None:
    """The first of the candidates that the table has."""
    found = next((c for c in candidates if c in df.columns), None)
    return found or (df.columns[0] if fall_back and df.columns else None)


def named_columns(df: DataFrame, prefix: str = "", numeric: bool = False) -> list[str]:
    kinds = ("tinyint", "smallint", "int", "bigint", "float", "double")
    return [c for c, t in df.dtypes if c.startswith(prefix) and (not numeric or t in kinds or t.startswith("decimal"))]


def rename_score(df: DataFrame, name: str, keys: tuple[str, ...] = ("gene", "width", "length")) -> DataFrame:
    """The first numeric column that is no key gets the name."""
    first = next((c for c in named_columns(df, numeric=True) if c not in keys), None)
    return df.withColumnRenamed(first, name) if first else df


def safe_locus_tag(sample_id: Column, most: int = 24) -> Column:
    """Letters, digits and underscores; a longer id ends in six digits of its md5."""
    plain = F.regexp_replace(sample_id, "[^A-Za-z0-9_]", "_")
    return F.when(F.length(plain) <= most, plain).otherwise(F.concat(F.substring(plain, 1, most - 7), F.lit("_"), F.substring(F.md5(sample_id), 1, 6)))


def short_contig_ids(records: DataFrame, most: int = 37) -> DataFrame:
    """Adds new_id: contig_NNNN where the id of (sample_id, gene) is too long, numbered within its sample."""
    long = records.where(F.length("gene") > most).select("sample_id", "gene").distinct()
    numbered = long.withColumn("new_id", F.format_string("contig_%04d", F.row_number().over(Window.partitionBy("sample_id").orderBy("gene"))))
    return records.join(numbered, ["sample_id", "gene"], "left").withColumn("new_id", F.coalesce("new_id", "gene"))


def label(gene: Column, definition: Column, most: int = 55) -> Column:
    """definition (gene), cut with an ellipsis; the gene alone without a definition."""
    whole = F.when(F.coalesce(F.trim(definition), F.lit("")) == "", gene).otherwise(F.concat(F.trim(definition), F.lit(" ("), gene, F.lit(")")))
    return F.when(F.length(whole) > most, F.concat(F.substring(whole, 1, most - 1), F.lit("…"))).otherwise(whole)


# ---------------------------------------------------------------- positions
def _lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(file, line_no, line of text files, whatever parts they are read in; file, begin: the line where its sequences begin).

    ``line_no`` orders a file's lines: the start of the part that a line is in, and its place there.
    """
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.struct(F.col("_metadata.file_block_start").alias("part"), F.monotonically_increasing_id().alias("place")).alias("line_no"), F.col("value").alias("line"))
    return rows, rows.where(F.startswith("line", F.lit("##FASTA"))).groupBy("file").agg(F.min("line_no").alias("begin"))


def _features(spark: SparkSession, path: str) -> DataFrame:
    """file, line_no, line, p: lines of GFF files in their order, up to the sequences."""
    rows, sequences = _lines(spark, path)
    above = rows.join(sequences, "file", "left").where(F.col("begin").isNull() | (F.col("line_no") < F.col("begin")))
    return above.select("file", "line_no", "line", F.split("line", "\t").alias("p"))


def _ids(attributes: Column) -> Column:
    """Candidate ids by priority, each followed by what is left without a prefix."""
    raw = [F.regexp_extract(attributes, rf"(?:^|;)\s*{a}=([^;]+)", 1) for a in ID_ATTRIBUTES]
    every = [x for r in raw for x in (r, *[F.when(F.startswith(r, F.lit(p)), F.substring(r, len(p) + 1, 1 << 20)) for p in ID_PREFIXES])]
    return F.filter(F.array(*every), lambda x: x.isNotNull() & (x != ""))


def _resolved(rows: DataFrame, genes: DataFrame) -> DataFrame:
    """Adds gene: the first candidate of each feature that is a known gene; features without one go."""
    tried = rows.withColumn("ids", _ids(F.col("p")[8])).select("*", F.posexplode("ids").alias("nth", "id"))
    known = tried.join(genes.select(F.col("gene").alias("id")).distinct(), "id")
    first = known.groupBy("file", "line_no").agg(F.min_by("id", "nth").alias("gene"))
    return rows.join(first, ["file", "line_no"])


def gene_positions(spark: SparkSession, path: str, genes: DataFrame, kinds: tuple[str, ...] = ("gene", "CDS")) -> DataFrame:
    """gene, seqid, start, end, strand: of each known gene its first feature in the file."""
    rows = _features(spark, path).where((F.size("p") >= 9) & ~F.startswith("line", F.lit("#")) & F.col("p")[2].isin(*kinds))
    rows = rows.withColumn("start", F.col("p")[3].try_cast("long")).withColumn("end", F.col("p")[4].try_cast("long")).where("start is not null and end is not null")
    found = _resolved(rows, genes).select("file", "line_no", "gene", F.col("p")[0].alias("seqid"), "start", "end", F.col("p")[6].alias("strand"))
    first = found.groupBy("gene").agg(F.min(F.struct("file", "line_no", "seqid", "start", "end", "strand")).alias("f"))
    return first.select("gene", "f.seqid", "f.start", "f.end", "f.strand")


def positions_or_order(found: DataFrame, genes: DataFrame, least: int = 10) -> DataFrame:
    """gene, position: start in thousands, or the genes' own order (gene, nth) where no more than ``least`` are placed."""
    placed = found.select("gene", (F.col("start") / 1000).alias("position"))
    return placed if placed.limit(least + 1).count() > least else genes.select("gene", F.col("nth").cast("double").alias("position"))


def contig_sequences(spark: SparkSession, gff: str, fasta: str | None = None) -> DataFrame:
    """seqid, seq: of the FASTA file, or of the GFF file's own sequences without one."""
    if fasta is not None:
        return read_fasta(spark, fasta).select(F.col("gene").alias("seqid"), F.upper("seq").alias("seq"))
    rows, sequences = _lines(spark, gff)
    below = rows.join(sequences, "file").where(F.col("line_no") > F.col("begin")).withColumn("head", F.startswith("line", F.lit(">")).cast("int"))
    records = ordered(below, F.col("file"), F.col("line_no"), sums={"record": "head"}).where("record > 0")
    whole = records.groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("line_no", "head", "line"))).alias("es"))  # one sequence
    seqid = F.regexp_extract(F.element_at("es", 1)["line"], r"^>\s*(\S+)", 1)
    return whole.select(seqid.alias("seqid"), F.upper(F.regexp_replace(F.array_join(F.transform(F.filter("es", lambda e: e["head"] == 0), lambda e: e["line"]), ""), r"\s", "")).alias("seq")).where("seqid <> ''")


# ---------------------------------------------------------------- tRNA genes
def anticodons(spark: SparkSession) -> DataFrame:
    """aa, anticodon (DNA), codon (RNA): which anticodons read an amino acid by plain pairing."""
    return codon_dim(spark).where("aa <> 'Stop'").select("aa", F.expr("reverse(translate(codon, 'ACGU', 'TGCA'))").alias("anticodon"), "codon")


def trna_counts(spark: SparkSession, gff: str, fasta: str | None = None) -> DataFrame:
    """anticodon, codon, aa, copies, weight, effective: tRNA genes, and the codons that each reads by wobble.

    An annotated triplet counts if it reads the annotated amino acid; else the triplet
    nearest to the anticodon's place in the gene that does; else the gene is left out.
    """
    rows = _features(spark, gff).where((F.size("p") >= 9) & ~F.startswith("line", F.lit("#")) & (F.col("p")[2] == "tRNA"))
    attributes = F.col("p")[8]
    word = F.regexp_replace(F.regexp_extract(attributes, r"(?i)product=tRNA-(\w+)", 1), r"\d+$", "")
    aa = F.when(F.lower(word).isin("fmet", "imet"), "Met").otherwise(F.initcap(word))
    rows = rows.select("file", "line_no", F.col("p")[0].alias("seqid"), F.col("p")[3].try_cast("long").alias("start"), F.col("p")[4].try_cast("long").alias("end"), F.col("p")[6].alias("strand"), attributes.alias("attributes"), aa.alias("aa"))
    said = F.concat(F.regexp_extract_all(F.regexp_extract("attributes", r"anticodon=([^;]+)", 1), F.lit("(?i)([ACGTU]{3})"), F.lit(1)), F.regexp_extract_all("attributes", F.lit(r"(?i)\(([ACGTU]{3})\)"), F.lit(1)))
    rows = rows.withColumn("said", F.transform(said, lambda t: F.translate(F.upper(t), "U", "T")))
    rows = rows.join(contig_sequences(spark, gff, fasta), "seqid", "left")
    gene = F.when((F.col("start") > 0) & (F.col("start") <= F.col("end")) & (F.col("end") <= F.length("seq")), F.expr("substr(seq, start, end - start + 1)"))
    rows = rows.withColumn("gene", F.when(F.col("strand") == "-", reverse_complement(gene)).otherwise(gene))
    near = F.transform(F.sequence(F.lit(ANTICODON_AT - ANTICODON_OFF), F.lit(ANTICODON_AT + ANTICODON_OFF)), lambda i: F.struct(F.abs(i - ANTICODON_AT).alias("off"), i.alias("i"), F.substring(F.col("gene"), i + 1, F.lit(3)).alias("t")))
    rows = rows.withColumn("near", F.transform(F.array_sort(near), lambda x: x["t"])).withColumn("tried", F.concat("said", F.coalesce("near", F.array().cast("array<string>"))))
    tried = rows.select("file", "line_no", "aa", F.posexplode("tried").alias("nth", "anticodon")).join(F.broadcast(anticodons(spark).select("aa", "anticodon")), ["aa", "anticodon"])  # 61 rows
    chosen = tried.groupBy("file", "line_no", "aa").agg(F.min_by("anticodon", "nth").alias("anticodon"))
    copies = chosen.groupBy("anticodon", "aa").agg(F.count("*").alias("copies"))
    pairs = spark.createDataFrame(WOBBLE, "first string, third string, weight double")
    stem = F.expr("translate(reverse(substr(anticodon, 2, 2)), 'ACGT', 'UGCA')")
    read = copies.join(F.broadcast(pairs), F.translate(F.substring("anticodon", 1, 1), "T", "U") == F.col("first"))  # 8 rows
    return read.select("anticodon", F.concat(stem, "third").alias("codon"), "aa", "copies", "weight", (F.col("copies") * F.col("weight")).alias("effective"))


# ---------------------------------------------------------------- bridges and names
def read_bridge(spark: SparkSession, path: str) -> DataFrame:
    """ko, pathway: a map without header; prefixes go, and so do map pathways, which repeat others."""
    p = F.split(F.trim("value"), "\t")
    rows = spark.read.text(path).where((F.trim("value") != "") & ~F.startswith(F.ltrim("value"), F.lit("#")) & (F.size(p) >= 2))
    rows = rows.select(F.regexp_replace(F.trim(p[0]), "^ko:", "").alias("ko"), F.regexp_replace(F.trim(p[1]), "^(path:|md:)", "").alias("pathway"))
    return rows.where(~F.startswith("pathway", F.lit("map"))).distinct()


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """id, name: names by id without prefix; a pathway number also under its other prefixes, where these have no name of their own."""
    rows = spark.read.text(path).where((F.trim("value") != "") & ~F.startswith("value", F.lit("#")) & F.contains("value", F.lit("\t")))
    rows = rows.select(F.regexp_replace(F.trim(F.substring_index("value", "\t", 1)), "^(path:|ko:|md:)", "").alias("id"), F.trim(F.regexp_replace("value", "^[^\t]*\t", "")).alias("name"))
    number = F.regexp_extract("id", r"^(?:ko|map)?(\d{5})$", 1)
    alias = rows.where(number != "").select(F.explode(F.array(F.concat(F.lit("ko"), number), F.concat(F.lit("map"), number), number)).alias("id"), "name")
    own = rows.groupBy("id").agg(F.max("name").alias("name"))
    return own.union(alias.join(own, "id", "left_anti").groupBy("id").agg(F.min("name").alias("name")))


def gene_sets(annotated: DataFrame, bridge: DataFrame) -> DataFrame:
    """gene_set, gene: genes (gene, ko) by the sets of their ids."""
    return annotated.join(bridge, "ko").select(F.col("pathway").alias("gene_set"), "gene").distinct()


def letter_sets(annotated: DataFrame) -> DataFrame:
    """gene_set, gene: one set for each letter of (gene, letters); JK belongs to J and K."""
    return annotated.select(F.explode(F.split("letters", "")).alias("gene_set"), "gene").where(F.rlike("gene_set", F.lit("^[A-Z]$"))).distinct()


def ribosomal(genes: DataFrame, name: str = "description") -> DataFrame:
    return genes.where(F.rlike(name, F.lit(RIBOSOMAL_NAME)))


def read_delimited(spark: SparkSession, path: str) -> DataFrame:
    """A table with a header, by tabs, commas, semicolons or bars: whichever its first line has most of."""
    head = spark.read.text(path).limit(1).collect()  # one line
    line = head[0]["value"] if head else ""
    return spark.read.option("header", True).option("inferSchema", True).option("sep", max("\t,;|", key=line.count)).csv(path)


def read_signatures(spark: SparkSession, folder: str) -> DataFrame:
    """All genome signatures below a folder as one table, the first of each sample_id by path."""
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*_genome_signature.tsv").option("header", True).option("sep", "\t").csv(folder).withColumn("path", F.input_file_name())
    return rows.withColumn("r", F.row_number().over(Window.partitionBy("sample_id").orderBy("path"))).where("r = 1").drop("r", "path")


def read_distances(spark: SparkSession, path: str, samples: DataFrame) -> DataFrame | None:
    """x, y, distance of a square table (first column: names); None if a sample is missing."""
    rows = spark.read.option("header", True).option("sep", "\t").csv(path)
    name, columns = rows.columns[0], rows.columns[1:]
    if samples.select("sample_id").distinct().join(rows.select(F.col(f"`{name}`").alias("sample_id")), "sample_id", "left_anti").limit(1).count() or samples.where(~F.col("sample_id").isin(columns)).limit(1).count():
        return None
    long = rows.unpivot([name], columns, "y", "distance").withColumnRenamed(name, "x").withColumn("distance", F.col("distance").try_cast("double"))
    return long.join(samples.select(F.col("sample_id").alias("x")), "x").join(samples.select(F.col("sample_id").alias("y")), "y").select("x", "y", "distance")


def newick_distances(spark: SparkSession, newick: str, samples: list[str]) -> DataFrame | None:
    """x, y, distance: path lengths between named nodes of a tree in Newick text; None if a sample is not there."""
    parent, length, node_of, at = [-1], [0.0], {}, 0
    for part in re.findall(r"[(),;]|[^(),;]+", newick.strip()):
        if part in "(,":
            parent.append(at if part == "(" else parent[at])
            length.append(0.0)
            at = len(parent) - 1
        elif part == ")":
            at = parent[at]
        elif part != ";":
            name, _, size = part.partition(":")
            node_of[name.strip()], length[at] = at, float(size or 0)
    if set(samples) - set(node_of):
        return None

    def above(k: int) -> dict[int, float]:
        """Distance to each node on the way to the root."""
        out, total = {}, 0.0
        while k >= 0:
            out[k], total, k = total, total + length[k], parent[k]
        return out

    up = {s: above(node_of[s]) for s in samples}
    rows = [(a, b, min(up[a][k] + up[b][k] for k in up[a].keys() & up[b].keys())) for a in samples for b in samples]
    return spark.createDataFrame(rows, "x string, y string, distance double")


def read_sample_tables(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """The tables <sample>_<kind>.tsv anywhere below a folder as one, with sample_id from the file's name."""
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"*_{kind}.tsv").option("header", True).option("sep", "\t").csv(folder)
    return rows.withColumn("sample_id", F.regexp_extract(F.input_file_name(), rf"([^/]+)_{kind}\.tsv$", 1))


# ---------------------------------------------------------------- sinks
def annotated_gff(spark: SparkSession, path: str, classes: DataFrame, islands: DataFrame | None = None) -> DataFrame:
    """file, value: the lines of GFF files, each CDS of a known gene followed by its codon-usage class, islands after the header.

    ``classes``: gene, category (both, rp_only, dens_only, neither), foreign; ``islands``: seqid, start, end, island.
    """
    rows = _features(spark, path)
    cds = rows.where((F.size("p") >= 9) & ~F.startswith("line", F.lit("#")) & (F.col("p")[2] == "CDS"))
    kind = F.when(F.col("category").isin("both", "rp_only"), "streamlined_CU").when(F.col("category") == "dens_only", "genome_standard_CU").otherwise("HGT_candidate")
    marks = _resolved(cds, classes).join(classes, "gene").withColumn("kind", kind)
    text = F.concat_ws(";", F.concat(F.lit("ID="), "gene", F.lit("_cu")), F.concat(F.lit("Parent="), "gene"), F.concat(F.lit("Name="), "kind"), F.concat(F.lit("codon_usage_class="), "kind"), F.concat(F.lit("dual_anchor_category="), "category"), F.when(F.col("foreign"), "hgt_mahal_flag=True"))
    p = F.col("p")
    extra = marks.select("file", "line_no", F.lit(1).alias("sub"), F.concat_ws("\t", p[0], F.lit("synonymy"), F.lit("codon_usage"), p[3], p[4], F.lit("."), p[6], F.lit("."), text).alias("value"))
    out = rows.select("file", "line_no", F.lit(0).alias("sub"), F.col("line").alias("value")).union(extra)
    if islands is not None:
        first = rows.where(~F.startswith("line", F.lit("#"))).groupBy("file").agg(F.min("line_no").alias("line_no"))
        at = F.concat_ws("\t", "seqid", F.lit("synonymy"), F.lit("genomic_island"), F.col("start").cast("string"), F.col("end").cast("string"), F.lit("."), F.lit("."), F.lit("."), F.concat(F.lit("ID="), "island"))
        out = out.union(first.crossJoin(F.broadcast(islands.select(at.alias("value")))).select("file", "line_no", F.lit(-1).alias("sub"), "value"))  # a few regions a genome
    return out.where("value <> ''").orderBy("file", "line_no", "sub", "value").select("file", "value")


def split_fasta(records: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """value: FASTA records (gene, seq) of the ids, and of all others."""
    text = F.concat(F.lit(">"), "gene", F.lit("\n"), "seq").alias("value")
    key = ids.select("gene").distinct()
    return records.join(key, "gene", "left_semi").select(text), records.join(key, "gene", "left_anti").select(text)


def merged_annotations(*tables: DataFrame) -> DataFrame:
    """gene and the other columns of tables, each with one row a gene (the least), outer-joined."""
    out = None
    for t in tables:
        others = [c for c in t.columns if c != "gene"]
        one = t.groupBy("gene").agg(F.min(F.struct(*others)).alias("s")).select("gene", "s.*")
        out = one if out is None else out.join(one, "gene", "full")
    return out
