"""Exceptions raised by readers, guards and quality gates."""

from __future__ import annotations


class IngestError(ValueError):
    """A source file or archive does not follow the expected layout."""


class GuardError(ValueError):
    """An operator received a frame that breaks its input contract."""


class DataQualityError(RuntimeError):
    """A quality report contains at least one failure."""

    def __init__(self, stage: str, failures: list[str]):
        self.stage = stage
        self.failures = list(failures)
        super().__init__(f"{stage}: " + " ".join(self.failures))
