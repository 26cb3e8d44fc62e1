"""Universe, macro series, benchmark roles and asset classification, all plain parameters."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

# Default universe, macro series with their column names, benchmarks, asset classes.
DEFAULT_SYMBOLS = ("AAPL", "MSFT", "GOOGL")
DEFAULT_SERIES = {"CPIAUCSL": "cpi", "FEDFUNDS": "fedFundsRate", "DGS10": "treasury10y"}
MARKET_PROXY = "SPY"
SECTOR_BENCHMARK = "XLK"
ETF_SYMBOLS = ("QQQ", "XLK", "VGT", "SOXX")
SEMICONDUCTORS = ("SOXX", "NVDA", "AMD", "AVGO")
DEFAULT_SECTOR = "Tech (broad)"


def listed(text: str | None, default: tuple[str, ...]) -> tuple[str, ...]:
    """Names in a comma-separated ``text``; ``default`` when it is unset or blank."""
    if text is None or not text.strip():
        return tuple(default)
    return tuple(name.strip() for name in text.split(",") if name.strip())


def macro_columns(series: dict[str, str]) -> list[str]:
    """The default macro columns, which the features use, then any others in ``series``."""
    standard = list(DEFAULT_SERIES.values())
    return standard + [name for name in series.values() if name not in standard]


@dataclass(frozen=True)
class Universe:
    """Which symbols and macro series a run covers. No symbols means every landed symbol."""

    symbols: tuple[str, ...] | None = None
    series: dict[str, str] = field(default_factory=lambda: dict(DEFAULT_SERIES))

    @classmethod
    def from_text(
        cls,
        symbols: str | None = None,
        series: str | None = None,
        column_of: dict[str, str] | None = None,
    ) -> "Universe":
        """Read both comma-separated lists; a series without a known column keeps its own id."""
        names = {**DEFAULT_SERIES, **(column_of or {})}
        chosen = listed(series, tuple(DEFAULT_SERIES))
        return cls(listed(symbols, DEFAULT_SYMBOLS), {s: names.get(s, s) for s in chosen})

    @property
    def macro_columns(self) -> list[str]:
        return macro_columns(self.series)


@dataclass(frozen=True)
class Classification:
    """Asset type and sector per symbol. Sectors are tried in order and the first match wins."""

    etfs: tuple[str, ...] = ETF_SYMBOLS
    sectors: tuple[tuple[str, tuple[str, ...]], ...] = (("Semiconductors", SEMICONDUCTORS),)
    default_sector: str = DEFAULT_SECTOR


@dataclass(frozen=True)
class Roles:
    """The market proxy, the sector benchmark and the classification used by views and queries."""

    market: str = MARKET_PROXY
    sector_benchmark: str = SECTOR_BENCHMARK
    classes: Classification | DataFrame = field(default_factory=Classification)
    benchmark_of: dict[str, str] = field(default_factory=dict)   # sector to its own benchmark
