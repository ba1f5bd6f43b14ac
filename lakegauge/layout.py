"""Folder layout of a lake: one base path, one folder per zone."""

from __future__ import annotations

from dataclasses import dataclass

# Every table is partitioned by these two; a dataset owns exactly one (season, playoffs) partition.
PARTITION_COLUMNS = ("season", "playoffs")


@dataclass(frozen=True)
class Lake:
    """Paths under one base, which may be any file system Spark reads."""

    base: str

    def __post_init__(self) -> None:
        object.__setattr__(self, "base", self.base.rstrip("/"))

    @property
    def raw(self) -> str:
        return f"{self.base}/raw"

    @property
    def checksums(self) -> str:
        return f"{self.base}/checksums"

    @property
    def capture(self) -> str:
        return f"{self.base}/capture"

    def zone(self, zone: str) -> str:
        return f"{self.base}/{zone}"

    def captured(self, source: str) -> str:
        return f"{self.capture}/{source}"

    def bronze(self, source: str) -> str:
        return f"{self.zone('bronze')}/{source}"
