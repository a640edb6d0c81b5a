"""The run clock: one stamp, taken once, carried through every layer."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from zoneinfo import ZoneInfo

LAKE_ZONE = "America/Sao_Paulo"


@dataclass(frozen=True)
class RunStamp:
    """When a run happened, as the three integers the tables carry.

    ``ref`` is ``yyyyMMdd``, ``ref_partition`` is ``yyyyMM`` and ``ts_proc`` is
    ``yyyyMMddHHmmss``. A run builds one and hands it to all layers, so that a
    run crossing midnight or a month's end still reads the month it wrote.
    """

    ref: int
    ref_partition: int
    ts_proc: int

    @classmethod
    def at(cls, moment: datetime, zone: str = LAKE_ZONE) -> RunStamp:
        if moment.tzinfo is None:
            raise ValueError("a run stamp needs a moment with a time zone")
        local = moment.astimezone(ZoneInfo(zone))
        return cls(
            ref=int(local.strftime("%Y%m%d")),
            ref_partition=int(local.strftime("%Y%m")),
            ts_proc=int(local.strftime("%Y%m%d%H%M%S")),
        )

    @classmethod
    def now(cls, zone: str = LAKE_ZONE) -> RunStamp:
        return cls.at(datetime.now(ZoneInfo(zone)), zone)

    @property
    def month(self) -> str:
        """The month folder, ``YYYY-MM``."""
        return f"{self.ref_partition // 100:04d}-{self.ref_partition % 100:02d}"
