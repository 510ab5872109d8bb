"""The identity of one run: its id, its date and its clock."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date, datetime, timezone

# A run id becomes a directory name and a partition value.
_SAFE_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


@dataclass(frozen=True)
class Run:
    """One run of a job.

    The three values are fixed before Spark starts, so that every stage of a run uses
    the same date (also past midnight) and a re-run with the same values writes the
    same rows to the same place.
    """

    run_id: str
    processing_date: str
    processed_at: datetime

    def __post_init__(self) -> None:
        if not _SAFE_ID.fullmatch(self.run_id):
            raise ValueError(f"run id {self.run_id!r} is not a plain name")
        date.fromisoformat(self.processing_date)
        if self.processed_at.tzinfo is None:
            raise ValueError("processed_at needs a time zone")

    @classmethod
    def start(
        cls,
        run_id: str | None = None,
        processing_date: str | None = None,
        now: datetime | None = None,
    ) -> Run:
        """A run that begins now; each value may be given by the caller."""
        now = now or datetime.now(timezone.utc)
        utc = now.astimezone(timezone.utc)
        return cls(
            run_id=run_id or utc.strftime("%Y%m%dT%H%M%S.%fZ"),
            processing_date=processing_date or utc.date().isoformat(),
            processed_at=now,
        )

    def directory(self, root: str, date_column: str = "processing_date") -> str:
        """This run's partition directory under a table root (any URI scheme)."""
        return f"{root.rstrip('/')}/{date_column}={self.processing_date}/run_id={self.run_id}"
