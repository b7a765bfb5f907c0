"""Rule-based classes of platforms, libraries and files."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds that may be overridden by parameters.
COVERAGE_ROWS, MIN_PROBE_ROWS, MIN_SEQ_GENES = 12_000, 8_000, 16_000
# Patterns of technologies, vendors and contents.
SEQUENCING, SINGLE_CELL, ARRAY = r"(?i)high.?throughput sequencing", r"(?i)single.?cell|single.?nucle", r"(?i)oligonucleotide|spotted|in situ"
VENDORS = ["affymetrix", "illumina", "agilent"]
CONTENTS = [("cna", r"(?i)copy number|\bcgh\b|\bsnp\b|genotyping array|\bcnv\b"), ("mrna", r"(?i)\bmrna\b|gene expression|whole transcriptome"), ("mirna", r"(?i)\bmirna\b|micro.?rna"), ("lncrna", r"(?i)\blncrna\b|long non.?coding")]
LIBRARY_SELECTION = [("polyA", r"(?i)poly.?a|oligo.?dt"), ("exome_capture", r"(?i)hybrid selection|exome"), ("total_rna", r"(?i)random|ribo.?zero|rrna depletion")]
LIBRARY_PROTOCOL = [("exome_capture", r"(?i)exome"), ("polyA", r"(?i)poly-?a"), ("total_rna", r"(?i)ribo-?zero|rrna depletion|total rna")]
SINGLE_CELL_PLATFORMS = [("10x", r"(?i)10x|chromium|droplet"), ("smartseq", r"(?i)smart-?seq|fluidigm|plate-?based")]
REFERENCE_CHANNEL = r"(?i)\breference\b|\bpool(ed)?\b"
# File names.
SKIPPED_SUFFIXES = ["bam", "bai", "fastq", "fastq.gz", "fq", "fq.gz", "bw", "bigwig", "cel", "cel.gz"]
DATA_SUFFIXES = ["txt", "tsv", "csv", "xlsx", "xls"]
DERIVED_WORDS = ["diff", "deg", "significance", "clinical", "rmats", "dexseq", "novel_filtered", ".original"]
UNITS = ["tpm", "fpkm", "rpkm", "cpm", "count"]
# Column names of genomic tables that are no expression matrix.
GENOMIC_SIGNATURES = [
    ["chr", "chrom", "chromosome", "start", "end", "pos", "position", "strand"],
    ["ref", "alt", "qual", "filter", "info", "format"],
    ["hugo_symbol", "variant_classification", "variant_type", "reference_allele", "tumor_seq_allele1", "tumor_seq_allele2", "tumor_sample_barcode", "ncbi_build"],
]


def _first_match(text: Column, rules: list[tuple[str, str]], default: str | Column) -> Column:
    out = None
    for name, pattern in rules:
        out = F.when(text.rlike(pattern), name) if out is None else out.when(text.rlike(pattern), name)
    return out.otherwise(default)


def _text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def assay_type(technology: Column, title: Column) -> Column:
    """scrnaseq, bulk_rnaseq, microarray or other."""
    tech = _text(technology)
    return F.when(tech.rlike(SEQUENCING), F.when(_text(title).rlike(SINGLE_CELL), "scrnaseq").otherwise("bulk_rnaseq")).when(tech.rlike(ARRAY), "microarray").otherwise("other")


def vendor(manufacturer: Column, title: Column) -> Column:
    """The first known vendor named, else other."""
    return _first_match(F.concat_ws(" ", _text(manufacturer), _text(title)), [(v, f"(?i){v}") for v in VENDORS], "other")


def coverage(rows: Column, threshold: int = COVERAGE_ROWS) -> Column:
    """full_transcriptome from ``threshold`` rows on, limited below, unknown without a positive number."""
    n = rows.cast("string").try_cast("bigint")
    return F.when(n.isNull() | (n <= 0), "unknown").when(n >= threshold, "full_transcriptome").otherwise("limited")


def array_content(title: Column) -> Column:
    """What an array's probes measure: cna, mrna, mirna or lncrna; mrna where the title tells nothing."""
    return _first_match(_text(title), CONTENTS, "mrna")


def platform_class(technology: Column, title: Column, manufacturer: Column, rows: Column) -> Column:
    """A struct of all classes of a platform; those of arrays are null for other assays."""
    kind = assay_type(technology, title)
    array = kind == "microarray"
    return F.struct(
        kind.alias("assay_type"), F.when(array, vendor(manufacturer, title)).alias("vendor"), F.when(array, coverage(rows)).alias("coverage"), F.when(array, array_content(title)).alias("array_content")
    )


def platform_verdict(technology: Column, title: Column, rows: Column, min_rows: int = MIN_PROBE_ROWS) -> Column:
    """Struct (supported, reason): only arrays are gated, by content and number of rows."""
    n = rows.cast("string").try_cast("bigint")
    content = array_content(title)
    bad = (
        F.when(assay_type(technology, title) != "microarray", F.lit(None).cast("string"))
        .when(content != "mrna", F.concat(F.lit("array content is "), content))
        .when((n > 0) & (n < min_rows), F.concat(F.lit("only "), n.cast("string"), F.lit(" rows")))
    )
    return F.struct(bad.isNull().alias("supported"), bad.alias("reason"))


def rnaseq_library(selection: Column, protocol: Column) -> Column:
    """polyA, total_rna, exome_capture, other or unknown; the protocol counts only where the selection is blank or unspecified."""
    chosen = F.trim(_text(selection))
    said = (chosen != "") & (F.lower(chosen) != "unspecified")
    return F.when(said, _first_match(chosen, LIBRARY_SELECTION, "other")).otherwise(_first_match(_text(protocol), LIBRARY_PROTOCOL, "unknown"))


def single_cell_platform(*texts: Column) -> Column:
    """10x, smartseq or unknown from all texts of a series."""
    return _first_match(F.concat_ws(" ", *texts), SINGLE_CELL_PLATFORMS, "unknown")


def reference_hint(ch1: Column, ch2: Column) -> Column:
    """1 or 2 where exactly one channel's text names a reference or pool."""
    one, two = _text(ch1).rlike(REFERENCE_CHANNEL), _text(ch2).rlike(REFERENCE_CHANNEL)
    return F.when(one & ~two, 1).when(two & ~one, 2)


def skipped_url(url: Column) -> Column:
    """Whether a file of raw reads, tracks or scans is meant, by the path of its URL."""
    path = F.lower(F.coalesce(F.try_parse_url(url, F.lit("PATH")), url))
    return path.rlike(r"\.(?:" + "|".join(s.replace(".", r"\.") for s in SKIPPED_SUFFIXES) + r")$")


def data_file(name: Column) -> Column:
    """Whether a file name is of a table, packed or not."""
    return F.regexp_replace(F.lower(name), r"\.gz$", "").rlike(r"\.(?:" + "|".join(DATA_SUFFIXES) + r")$")


def matrix_candidate(name: Column) -> Column:
    """A table that isn't of one sample and no derived analysis."""
    low = F.lower(name)
    return data_file(name) & ~low.rlike(r"gsm\d+") & ~reduce(or_, [low.contains(w) for w in DERIVED_WORDS])


def quantity_unit(name: Column) -> Column:
    """Struct (rank, unit) of the first unit a file name holds; rank 5 and unknown without one."""
    low, rank, unit = F.lower(name), None, None
    for i, u in enumerate(UNITS):
        rank = F.when(low.contains(u), i) if rank is None else rank.when(low.contains(u), i)
        unit = F.when(low.contains(u), u) if unit is None else unit.when(low.contains(u), u)
    return F.struct(rank.otherwise(len(UNITS)).alias("rank"), unit.otherwise("unknown").alias("unit"))


def genomic_table(columns: Column) -> Column:
    """Whether at least three normalized column names are of one genomic signature."""
    return reduce(or_, [F.size(F.array_intersect(columns, F.array(*[F.lit(w) for w in words]))) >= 3 for words in GENOMIC_SIGNATURES])


def sample_count_fits(n_columns: Column, n_samples: Column) -> Column:
    """Within five, or 15 % (half to even), of the number of samples."""
    return (n_samples > 0) & (F.abs(n_columns - n_samples) <= F.greatest(F.lit(5), F.bround(n_samples * 0.15)))


# Gene symbols and tags of transcripts left out of a clean reference.
HISTONES, RECEPTORS = r"^(H1-[1-6]|H2AC\d+|H2BC\d+|H3C\d+|H4C\d+)$", r"^(IG[HKL][VDJC]|TR[ABGD][VDJC])($|[0-9-])"
BAD_TAGS, MIN_TRANSCRIPT = ["readthrough_gene", "artifactual_duplication"], 300


def exclusion_reason(chrom: Column, symbol: Column, gene_type: Column, tags: Column, transcript_type: Column, length: Column, ccds: Column, remap_status: Column, remap_mappings: Column) -> Column:
    """The first of ten rules by which a transcript is left out, as a word; null keeps it."""
    flagged = F.arrays_overlap(F.split(F.coalesce(tags, F.lit("")), ","), F.array(*[F.lit(t) for t in BAD_TAGS]))
    return (
        F.when(chrom == "chrM", "mitochondrial")
        .when(symbol.rlike(HISTONES), "replication_dependent_histone")
        .when(gene_type.rlike(r"^(IG|TR)_") | symbol.rlike(RECEPTORS), "receptor_segment")
        .when(gene_type != "protein_coding", "gene_not_coding")
        .when(flagged, "flagged_gene")
        .when(transcript_type != "protein_coding", "transcript_not_coding")
        .when(length < MIN_TRANSCRIPT, "too_short")
        .when(F.coalesce(ccds, F.lit("")) == "", "no_consensus_cds")
        .when(~F.coalesce(remap_status, F.lit("")).isin("", "full_contig"), "unreliable_remap")
        .when(~F.coalesce(remap_mappings, F.lit("")).isin("", "1"), "several_mappings")
    )
