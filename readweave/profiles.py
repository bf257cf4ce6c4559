"""Parameter sets of the sequencing technologies."""

from __future__ import annotations

from dataclasses import dataclass

from readweave.operators.gapped import Scores


@dataclass(frozen=True)
class Profile:
    name: str
    mask: bool  # mask over-represented k-mers and split off repeats
    min_length: int  # least read length and least unmasked length when masking
    seed: int  # word length of the seed join
    step: int  # distance of the words taken from the target side
    exact: int  # least exact run on a diagonal
    identity: float
    max_word_share: float | None  # drop words over this order statistic of word counts
    overlap: int  # both sides of an overlap must be longer
    capped: bool  # clusters over the coverage bound collapse
    min_side: int  # least distance of a reported difference from either end
    fishing: bool  # remove repeats by graph instead of by alignment
    quality_bias: int
    scores: Scores = Scores(match=1, mismatch=3, gap_open=1, gap_extend=3, drop=10)
    gaps: bool = True  # differences by gap alternation instead of by columns of two bases


GENOME_454 = Profile("454", True, 100, 13, 26, 40, 0.96, None, 100, True, 50, False, 1)
TRANSCRIPT_454 = Profile("454-transcript", False, 0, 13, 26, 40, 0.96, 0.90, 100, False, 50, False, 0)
ILLUMINA = Profile("illumina", False, 0, 13, 11, 13, 0.96, 0.90, 50, True, 40, True, 0, Scores(match=1, mismatch=10, gap_open=10, gap_extend=10, drop=20), False)
PROFILES = {p.name: p for p in (GENOME_454, TRANSCRIPT_454, ILLUMINA)}
