"""Identifiers in one form, and names built from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from filigree.runtime import dashed_accession, padded_cik, plain_accession

__all__ = ["accession_year", "chunk_id", "context_prefix", "dashed_accession", "document_url", "filing_path", "padded_cik", "plain_accession", "ticker"]


def ticker(col: Column) -> Column:
    """Upper case and trimmed; null where it is no ticker: letters with a share class, or up to ten letters, digits, points and dashes."""
    t = F.upper(F.trim(col))
    return F.when(t.rlike(r"^[A-Z]{1,5}(-[A-Z])?$") | t.rlike(r"^[A-Z0-9.\-]{1,10}$"), t)


def accession_year(col: Column) -> Column:
    """The year in a dashed accession number; two digits under 50 belong to this century. Without dashes: unknown."""
    two = F.get(F.split(col, "-"), F.lit(1)).try_cast("int")
    return F.when(~F.contains(col, F.lit("-")) | two.isNull(), F.lit("unknown")).when(two < 50, (two + 2000).cast("string")).otherwise((two + 1900).cast("string"))


def chunk_id(accession: Column, item: Column, index: Column) -> Column:
    return F.format_string("%s_%s_%04d", accession, F.upper(F.regexp_replace(item, " ", "")), index)


def context_prefix(ticker_: Column, date: Column, item: Column, form: str = "10-K") -> Column:
    return F.format_string(f"Company: %s | Filing: {form} %s | Section: %s", ticker_, date, item)


def document_url(base: str, cik: Column, accession: Column, document: Column) -> Column:
    return F.concat_ws("/", F.lit(base), F.ltrim(cik, F.lit("0")), plain_accession(accession), document)


def filing_path(cik: Column, accession: Column, ticker_: Column, name: Column) -> Column:
    """year/CIK_TICKER_Name/accession, with signs in names replaced."""
    folder = F.concat_ws("_", padded_cik(cik), ticker_, F.regexp_replace(F.trim(name), "[^A-Za-z0-9]+", "_"))
    return F.concat_ws("/", accession_year(accession), folder, accession)
