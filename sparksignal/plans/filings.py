"""Filings to sector probabilities."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.html import business_section_rows, filing_text
from ..operators.similarity import sector_probabilities


def filing_sections(filings: DataFrame, html: str = "html", out: str = "section") -> DataFrame:
    """The business section of each filing; filings without one are left out."""
    others = [c for c in filings.columns if c != html]
    texts = filings.select(*others, filing_text(F.col(html)).alias("_text"))
    return texts.select(*others, business_section_rows(F.col("_text")).alias(out))


def filing_sectors(
    filings: DataFrame,
    categories: DataFrame,
    encode: Callable[[DataFrame], DataFrame],
    *,
    temperature: float = 0.03,
    sector: str = "sector",
) -> DataFrame:
    """Sector probabilities for every filing with a business section.

    ``encode`` turns a table with ``section`` into one with ``embedding``.
    """
    vectors = encode(filing_sections(filings)).drop("section")
    return sector_probabilities(vectors, categories, sector=sector, temperature=temperature)
