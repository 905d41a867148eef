"""Exceptions. ``reason`` is a stable code; the message carries counts, never row contents."""

from __future__ import annotations


class SnapshotError(Exception):
    """A batch, dimension or option that the rules refuse."""

    def __init__(self, reason: str, message: str) -> None:
        super().__init__(f"{reason}: {message}")
        self.reason = reason


class StorageError(SnapshotError):
    """A refused or failed table write.

    ``outcome`` is ``unchanged`` when nothing can have reached the table, and
    ``unknown`` once the publish has been submitted.
    """

    def __init__(
        self,
        reason: str,
        message: str,
        *,
        phase: str,
        outcome: str,
        run_id: str | None = None,
    ) -> None:
        super().__init__(reason, f"{message} [phase={phase}, outcome={outcome}]")
        self.phase = phase
        self.outcome = outcome
        self.run_id = run_id
