"""The codon dimension and scalar sequence functions, as Columns."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The bacterial genetic code over bases in the order U, C, A, G, and names of amino acids.
CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
NAMES = {
    "A": "Ala", "R": "Arg", "N": "Asn", "D": "Asp", "C": "Cys", "Q": "Gln", "E": "Glu", "G": "Gly", "H": "His", "I": "Ile", "L": "Leu",
    "K": "Lys", "M": "Met", "F": "Phe", "P": "Pro", "S": "Ser", "T": "Thr", "W": "Trp", "Y": "Tyr", "V": "Val", "*": "Stop",
}
MIN_LENGTH = 240
COLUMNS = ("codon", "aa", "family", "fold", "ffold", "sense", "coding", "indep", "fourfold", "gc1", "gc2", "gc3")


def codon_rows() -> list[tuple]:
    """One row a codon: amino acid, synonymous family (six-fold ones split in four and two), sizes and flags."""
    codons = [a + b + c for a in "UCAG" for b in "UCAG" for c in "UCAG"]
    aa = {c: NAMES[x] for c, x in zip(codons, CODE, strict=True)}
    fold = Counter(aa.values())
    box = Counter((aa[c], c[:2]) for c in codons)
    family = {c: f"{aa[c]}{box[aa[c], c[:2]]}" if fold[aa[c]] == 6 else aa[c] for c in codons}
    ffold = Counter(family.values())
    last = {f: max(c for c in codons if family[c] == f) for f in ffold}
    out = []
    for c in sorted(codons):
        sense = aa[c] not in ("Stop", "Met", "Trp")
        out.append((c, aa[c], family[c], fold[aa[c]], ffold[family[c]], sense, aa[c] != "Stop", sense and c != last[family[c]], box[aa[c], c[:2]] == 4, *(int(x in "GC") for x in c)))
    return out


def codon_dim(spark: SparkSession) -> DataFrame:
    """The rows as literals, so the planner knows how small they are and broadcasts them."""
    row = lambda r: "(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")"
    return spark.sql(f"SELECT * FROM VALUES {', '.join(map(row, codon_rows()))} AS t({', '.join(COLUMNS)})")


def dna_to_rna(s: Column) -> Column:
    return F.translate(F.upper(s), "T", "U")


def reverse_complement(s: Column) -> Column:
    return F.reverse(F.translate(s, "ACGTacgt", "TGCAtgca"))


def wright_enc(gc3: Column) -> Column:
    """Expected effective number of codons under mutation bias alone."""
    return 2 + gc3 + 29 / (gc3 * gc3 + (1 - gc3) * (1 - gc3))


def effect_label(delta: Column) -> Column:
    return F.when(delta < 0.147, "negligible").when(delta < 0.33, "small").when(delta < 0.474, "medium").otherwise("large")
