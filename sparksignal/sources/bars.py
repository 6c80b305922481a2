"""Market bars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Price columns of a wide download and their names in the long table.
BAR_COLUMNS = {"Open": "open", "High": "high", "Low": "low", "Close": "close", "Volume": "volume"}


def bars_to_long(
    wide: DataFrame, tickers: Sequence[str], *, time: str = "Date", separator: str = "|"
) -> DataFrame:
    """Long bars from a table with one column per ticker and price, such as ``AAPL|Open``.

    Tickers without columns are skipped. The table is read once.
    """
    present = [t for t in tickers if f"{t}{separator}Close" in wide.columns]
    if not present:
        raise ValueError("none of the tickers is in the table")
    entries = [
        F.struct(
            F.lit(ticker).alias("ticker"),
            *[
                (
                    F.col(f"`{ticker}{separator}{name}`")
                    if f"{ticker}{separator}{name}" in wide.columns
                    else F.lit(None)
                )
                .cast("double")
                .alias(out)
                for name, out in BAR_COLUMNS.items()
            ],
        )
        for ticker in present
    ]
    return wide.select(F.col(time).alias("timestamp"), F.inline(F.array(*entries)))
