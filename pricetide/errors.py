"""Errors raised by gates and loads."""


class FeedRejected(ValueError):
    """A batch failed validation under the strict policy."""


class LoadRejected(ValueError):
    """Prepared facts broke a requirement of the warehouse."""


class SharedFolderMissing(RuntimeError):
    """Intermediate tables have no shared folder to go to."""
