"""Allele columns: trimming, alignment, frequency orientation, counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col


def right_trim(ref, alt) -> Column:
    """Drop the longest shared suffix while both alleles keep at least one base."""
    ref, alt = col(ref), col(alt)
    room = F.least(F.length(ref), F.length(alt)) - 1
    cuts = F.when(room > 0, F.sequence(F.lit(1), room)).otherwise(F.array().cast("array<int>"))
    shared = F.size(F.filter(cuts, lambda k: F.right(ref, k) == F.right(alt, k)))
    return F.struct(F.left(ref, F.length(ref) - shared).alias("ref"), F.left(alt, F.length(alt) - shared).alias("alt"), shared.alias("trimmed"))


def variant_id(chrom, pos, ref, alt) -> Column:
    return F.concat_ws(":", col(chrom), col(pos).cast("string"), col(ref), col(alt))


def complement(a) -> Column:
    """Opposite strand of a single base; null for longer alleles, whose strand is not judged."""
    return F.when(F.length(col(a)) == 1, F.translate(col(a), "ACGT", "TGCA"))


def align_alleles(a1, a2, r1, r2) -> Column:
    """How reference alleles (r1, r2) sit on data alleles (a1, a2). Palindromes cannot be told apart by strand."""
    a1, a2, r1, r2 = map(col, (a1, a2, r1, r2))
    return (
        F.when(a1 == complement(a2), F.lit("strand_ambiguous"))
        .when((a1 == r1) & (a2 == r2), F.lit("same"))
        .when((a1 == r2) & (a2 == r1), F.lit("swapped"))
        .when((a1 == complement(r1)) & (a2 == complement(r2)), F.lit("strand_flip"))
        .when((a1 == complement(r2)) & (a2 == complement(r1)), F.lit("swapped_strand_flip"))
        .otherwise(F.lit("allele_mismatch"))
    )


def aligned_freqs(status, freqs) -> Column:
    """Frequencies in the data's allele order: one minus each when swapped, null when not aligned."""
    status = col(status)
    return F.when(status.isin("same", "strand_flip"), col(freqs)).when(
        status.isin("swapped", "swapped_strand_flip"), F.transform(col(freqs), lambda x: F.lit(1.0) - x)
    )


def alt_freq(a1, a2, ref, alt, a1_freq) -> Column:
    """Frequency of the ALT allele from a frequency given for A1; null when the allele pair differs."""
    a1, a2, ref, alt, f = map(col, (a1, a2, ref, alt, a1_freq))
    return F.when((a1 == alt) & (a2 == ref), f).when((a1 == ref) & (a2 == alt), F.lit(1.0) - f)


def frequency(alt_count, observed) -> Column:
    alt_count, observed = col(alt_count), col(observed)
    return F.when(observed > 0, alt_count / observed)


def minor_frequency(f) -> Column:
    f = col(f)
    return F.least(f, F.lit(1.0) - f)


def minor_count(alt_count, observed) -> Column:
    alt_count, observed = col(alt_count), col(observed)
    return F.when(observed > 0, F.least(alt_count, observed - alt_count))
