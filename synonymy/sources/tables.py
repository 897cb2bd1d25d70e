"""Sources: genome files in plain formats, and coding sequences from the document tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from synonymy.functions.codons import MIN_LENGTH, dna_to_rna

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cds_from_documents(documents: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """gene, sample_id, genome, cond, seq, length: each document's letters A, C, G, T as one coding sequence."""
    seq = F.upper(F.regexp_replace("text", "[^ACGTacgt]", ""))
    out = documents.select(F.col("doc_id").alias("gene"), F.concat_ws("-", "source", "lang").alias("sample_id"), F.col("source").alias("genome"), F.col("lang").alias("cond"), seq.alias("seq"))
    return out.withColumn("length", F.length("seq").cast("long")).where(F.col("length") >= min_length)


def codon_positions(cds: DataFrame, *keys: str) -> DataFrame:
    """keys, pos (from 1), codon: whole triplets of each sequence, as RNA."""
    triplets = F.regexp_extract_all(dna_to_rna(F.col("seq")), F.lit("([A-Z]{3})"), F.lit(1))
    return cds.select(*keys, F.posexplode(triplets).alias("p", "codon")).select(*keys, (F.col("p") + 1).cast("long").alias("pos"), "codon")


def read_fasta(spark: SparkSession, path: str, min_length: int = 0) -> DataFrame:
    """sample_id, gene, description, seq: records of FASTA files; the id is the header's first word."""
    rows = spark.read.option("lineSep", ">").text(path).where(F.length(F.trim("value")) > 0)
    head = F.substring_index("value", "\n", 1)
    seq = F.regexp_replace(F.expr("substr(value, length(substring_index(value, '\n', 1)) + 1)"), r"\s", "")
    out = rows.select(F.regexp_extract(F.input_file_name(), r"([^/]+?)(\.[^./]*)?$", 1).alias("sample_id"), F.regexp_extract(head, r"^\s*(\S+)", 1).alias("gene"), F.trim(head).alias("description"), seq.alias("seq"))
    return out.where(F.length("seq") >= min_length)


def checked_genome(spark: SparkSession, files: dict[str, str]) -> int:
    """Sequences in a genome's protein file; raises where ``files`` (by kind) lacks faa or ffn, or one of them is missing or empty."""
    for kind in ("faa", "ffn"):
        if kind not in files:
            raise ValueError(f"a genome's files must include {kind}; there are {sorted(files)}")
        p = spark._jvm.org.apache.hadoop.fs.Path(files[kind])
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(p) or not fs.getFileStatus(p).isFile():
            raise FileNotFoundError(files[kind])
        if fs.getFileStatus(p).getLen() == 0:
            raise ValueError(f"{files[kind]} is empty")
    return spark.read.text(files["faa"]).where(F.startswith("value", F.lit(">"))).count()


def read_gff(spark: SparkSession, path: str) -> DataFrame:
    """seqid, type, start, end, strand, attrs of GFF3 feature lines."""
    p = F.split("value", "\t")
    rows = spark.read.text(path).where(~F.startswith("value", F.lit("#")) & (F.size(p) >= 9))
    return rows.select(p[0].alias("seqid"), p[2].alias("type"), p[3].try_cast("long").alias("start"), p[4].try_cast("long").alias("end"), p[6].alias("strand"), F.str_to_map(p[8], F.lit(";"), F.lit("=")).alias("attrs"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """gene: the first word of each line that is no comment, once."""
    word = F.regexp_extract("value", r"^\s*(\S+)", 1)
    return spark.read.text(path).where(~F.startswith(F.ltrim("value"), F.lit("#"))).select(word.alias("gene")).where("gene <> ''").distinct()


def read_manifest(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """A table of samples, all strings, by the separator given or else the one of tab, comma, semicolon and bar that its first line has most of; sample_id defaults to the stem of genome_path, which must be there."""
    head = spark.read.text(path).limit(1).collect()  # one line
    found = max("\t,;|", key=head[0]["value"].count) if sep is None and head else sep or "\t"
    rows = spark.read.option("header", True).option("sep", found).csv(path)
    if "genome_path" not in rows.columns:
        raise ValueError("the manifest has no column genome_path")
    stem = F.regexp_extract("genome_path", r"([^/]+?)(\.[^./]*)?$", 1)
    return rows.withColumn("sample_id", F.coalesce(F.col("sample_id"), stem) if "sample_id" in rows.columns else stem)


def read_ko_hits(spark: SparkSession, path: str) -> DataFrame:
    """gene, ko, score: significant hits (marked *) of a detail table, the best of each gene."""
    p = F.split("value", "\t")
    rows = spark.read.text(path).where(F.startswith("value", F.lit("*")) & (F.size(p) >= 7)).select(p[1].alias("gene"), p[2].alias("ko"), p[4].try_cast("double").alias("score"), p[6].alias("definition"))
    best = Window.partitionBy("gene").orderBy(F.col("score").desc_nulls_last(), "ko")
    return rows.withColumn("r", F.row_number().over(best)).where("r = 1").drop("r")


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("sep", "\t").csv(path)
