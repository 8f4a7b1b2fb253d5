"""Job settings."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from .operators.decode import MAX_FRAME_BYTES
from .operators.typing import FAIL, QUARANTINE


@dataclass(frozen=True)
class IngestOptions:
    """``root`` holds control data, rejects and the staged generation; all executors must reach it.

    ``publish_views`` gives each table a SQL view of what is committed. ``owner`` is the job's own name, the same
    after a restart; with it a job refuses a root that a job of another name works on.
    """

    root: str
    flush_interval_secs: int = 600
    flush_jitter_secs: int = 120
    enable_manual_flush: bool = False
    on_bad_row: str = QUARANTINE
    max_frame_bytes: int = MAX_FRAME_BYTES
    admit_by_order: bool = True
    ordered_files: bool = False
    max_files_per_trigger: int | None = None
    max_bytes_per_trigger: str | None = None
    parallel_tables: int = 4
    publish_views: bool = False
    owner: str | None = None

    def __post_init__(self) -> None:
        if self.on_bad_row not in (QUARANTINE, FAIL):
            raise ValueError(f"on_bad_row is {QUARANTINE!r} or {FAIL!r}, not {self.on_bad_row!r}")
        if self.flush_interval_secs < 0 or self.flush_jitter_secs < 0:
            raise ValueError("flush interval and jitter are not negative")
        if self.parallel_tables < 1:
            raise ValueError("parallel_tables is at least 1")

    @classmethod
    def from_env(cls, root: str, env: Mapping[str, str], **others) -> IngestOptions:
        """The three flush settings by the names producers' deployments already use."""

        def seconds(name: str, default: int) -> int:
            try:
                return int(env.get(name, default))
            except ValueError:
                raise ValueError(f"{name} must be a number") from None

        return cls(
            root=root,
            flush_interval_secs=seconds("FLUSH_INTERVAL_SECS", 600),
            flush_jitter_secs=seconds("FLUSH_JITTER_SECS", 120),
            enable_manual_flush=env.get("ENABLE_MANUAL_FLUSH", "").lower() == "true",
            **others,
        )
