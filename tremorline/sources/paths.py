"""Folders of a run, the shared scratch folder, and the session check."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import SparkSession

# How a run's time is written in its folder names, and the names of
# the folders that hold landed documents and clean rows.
STAMP = "%Y%m%d_%H%M%S"
LANDING = "landing"
SILVER = "silver"
REJECTED = "rejected"
REPORTS = "reports"


@dataclass(frozen=True)
class Run:
    """One ingestion run; its folders share its stamp. A naive ``at`` is UTC."""

    root: str
    at: datetime = field(default_factory=lambda: datetime.now(timezone.utc))

    @property
    def stamp(self) -> str:
        at = self.at.astimezone(timezone.utc) if self.at.tzinfo else self.at
        return at.strftime(STAMP)

    @property
    def landing(self) -> str:
        return self._folder(LANDING)

    @property
    def silver(self) -> str:
        return self._folder(SILVER)

    @property
    def rejected(self) -> str:
        return self._folder(REJECTED)

    @property
    def report(self) -> str:
        return self._folder(REPORTS)

    def _folder(self, layer: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{self.stamp}"


def require_utc(spark: SparkSession) -> None:
    """Refuse a session in which days, partition values and written times would shift."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC"):
        raise ValueError(f"set spark.sql.session.timeZone to UTC (it is {zone})")


_local_root: str | None = None


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder named by ``spark.checkpoint.dir``.

    Only a session on one machine (``local[...]``) may leave that setting out.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        _local_root = _local_root or tempfile.mkdtemp(prefix="tremorline-")
        root = _local_root
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
