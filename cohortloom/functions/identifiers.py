"""Identifier columns: versions, composite headers, packed cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Identifier shapes.
TRANSCRIPT_ID, GENE_ID, CLONE_PLACEHOLDER = r"^ENST\d+$", r"^ENSG\d+$", r"^I_\d+$"
COMPOSITE_HEAD, EMBEDDED_ID, DOUBLED_SYMBOL = r"^(ENS[TG]\d+(?:\.\d+)?)\|", r"(ENS[TG]\d+(?:\.\d+)?)", r"^(.+)_(?:\d+_)?\1$"
# Gene symbols that nearly every human platform holds, and how many of them must be there.
CANONICAL_SYMBOLS = "GAPDH ACTB TP53 EGFR MYC KRAS BRCA1 BRCA2 PTEN VEGFA TNF IL6 INS ALB HBB CDKN2A RB1 APC PIK3CA".split()
MIN_CANONICAL = 5
# Shares of values from which an identifier type holds.
MIN_ID_SHARE, MIN_SYMBOL_SHARE, MIN_UNWRAP_SHARE = 0.5, 0.2, 0.5


def strip_version(value: Column) -> Column:
    """An identifier without its trailing version number."""
    return F.regexp_replace(value.cast("string"), r"\.\d+$", "")


def canonical_id(value: Column) -> Column:
    """The leading Ensembl id of a pipe-joined header, without version; other values without version."""
    return strip_version(F.coalesce(F.nullif(F.regexp_extract(value.cast("string"), COMPOSITE_HEAD, 1), F.lit("")), value.cast("string")))


def undoubled(value: Column) -> Column:
    """SYMBOL of SYMBOL_SYMBOL or SYMBOL_n_SYMBOL, else null."""
    return F.nullif(F.regexp_extract(value, DOUBLED_SYMBOL, 1), F.lit(""))


def embedded_id(value: Column) -> Column:
    """The Ensembl id anywhere in a value, else null."""
    return F.nullif(F.regexp_extract(value, EMBEDDED_ID, 1), F.lit(""))


def first_of_packed(cell: Column) -> Column:
    """The first of values joined by ' /// '; null marks and blanks are null."""
    text = F.trim(cell)
    return F.when((text != "") & (text != "---"), F.trim(F.split(text, " /// ")[0]))


def _records(cell: Column) -> Column:
    fields = F.transform(F.split(cell, " /// "), lambda r: F.transform(F.split(F.trim(r), r"\s*//\s*"), lambda f: F.trim(f)))
    named = F.filter(fields, lambda f: (F.size(f) >= 2) & (F.try_element_at(f, F.lit(2)) != "") & (F.try_element_at(f, F.lit(2)) != "---"))
    return F.try_element_at(named, F.lit(1))


def assigned_symbol(cell: Column) -> Column:
    """The symbol of the first record of a packed assignment that has one."""
    return F.try_element_at(_records(cell), F.lit(2))


def assigned_entrez(cell: Column) -> Column:
    """The last all-digit field of the first record with a symbol."""
    return F.try_element_at(F.filter(_records(cell), lambda f: f.rlike(r"^\d+$")), F.lit(-1))
