"""Column functions over nucleotide sequences. All are built from Spark's own functions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The IUPAC codes and their complements, in either case.
CODES = "ABCDGHKMNRSTVWYabcdghkmnrstvwy"
COMPLEMENTS = "TVGHCDMKNYSABWRtvghcdmknysabwr"


def reverse_complement(seq: Column | str) -> Column:
    return F.reverse(F.translate(seq, CODES, COMPLEMENTS))


def encode_base(base: Column | str) -> Column:
    """0 to 3 for A, C, G, T in either case, -1 for anything else."""
    up = F.upper(base)
    return F.when(up == "A", 0).when(up == "C", 1).when(up == "G", 2).when(up == "T", 3).otherwise(-1)


def kmer_code(word: Column | str) -> Column:
    """Two bits a base as a long; only for words of A, C, G, T."""
    return F.conv(F.translate(F.upper(word), "ACGT", "0123"), 4, 10).cast("long")


def kmer_decode(code: Column | str, k: int) -> Column:
    return F.translate(F.lpad(F.conv(F.col(code).cast("string") if isinstance(code, str) else code.cast("string"), 10, 4), k, "0"), "0123", "ACGT")


def canonical(word: Column | str) -> Column:
    return F.least(word, reverse_complement(word))


def without_n(seq: Column | str) -> Column:
    return F.translate(seq, "N", "A")


def only_iupac(seq: Column | str) -> Column:
    return F.regexp_replace(seq, "[^ABCDGHKMNRSTVWYabcdghkmnrstvwy]", "")


def compress_homopolymers(seq: Column | str) -> Column:
    return F.regexp_replace(seq, r"(.)\1+", "$1")


def wrap(seq: Column | str, width: int = 60) -> Column:
    """Lines of width bases without gaps."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(seq, "-", ""), f"(.{{{width}}})", "$1\n"), "\n$", "")


def unmasked_length(seq: Column | str) -> Column:
    return F.length(F.regexp_replace(seq, "[a-z]", ""))


def phred_decode(text: Column | str, offset: Column | int) -> Column:
    """Qualities of characters; none for an empty text, which split would give one empty character."""
    text = F.col(text) if isinstance(text, str) else text
    return F.when(text == "", F.expr("cast(array() as array<int>)")).otherwise(F.transform(F.split(text, ""), lambda c: F.ascii(c) - offset))


def phred_encode(quality: Column | str, offset: int = 33) -> Column:
    return F.array_join(F.transform(quality, lambda q: F.chr(q + offset)), "")


def first_token(header: Column | str) -> Column:
    return F.regexp_extract(header, r"^>?(\S*)", 1)


def joined_name(name: Column | str) -> Column:
    return F.array_join(F.split(name, r"\s+"), ":")


def accession(name: Column | str) -> Column:
    return F.regexp_extract(name, r"^[^._]*", 0)


def key_int(text: Column | str, key: str) -> Column:
    """The integer in key=value; null where there is none."""
    found = F.regexp_extract(text, f"{key}=([0-9]+)", 1)
    return F.when(found != "", found.cast("int"))


def base_class(char: Column | str) -> Column:
    """A, C, G, T, * for a gap, N for the rest."""
    up = F.upper(char)
    return F.when(up.isin("A", "C", "G", "T"), up).when(up.isin("*", "-"), "*").otherwise("N")


def low_quality_case(base: Column, quality: Column, limit: int = 20) -> Column:
    return F.when(quality <= limit, F.lower(base)).otherwise(base)


def has_homopolymer(seq: Column, pos: Column, length: int = 5, window: int = 13) -> Column:
    """Whether the window centred on the 0-based pos holds a run of length equal characters, in either case."""
    radius = window // 2
    start = F.greatest(pos - radius, F.lit(0))
    part = F.substring(seq, start + 1, pos + radius - start + 1)
    return F.lower(part).rlike(f"(.)\\1{{{length - 1}}}")


def kmer_size(total_bases: int) -> int:
    """Word length for a data set of so many bases; 1 at least."""
    return max(1, math.ceil(math.log(5 * total_bases) / math.log(4))) if total_bases > 0 else 1


def max_hits(bases_added: int, genome_size: int, unlimited: bool = False) -> int:
    """Members above which a cluster is taken for a repeat, from the Poisson distribution of coverage."""
    if unlimited:
        return 2**31 - 1 - 100
    coverage = bases_added / genome_size
    if coverage > 19:
        return int(2 * coverage + 1)
    m, term = 0, math.exp(-coverage)
    cdf = term
    while cdf < 0.9999:
        m += 1
        term *= coverage / m
        cdf += term
    return m + 2
