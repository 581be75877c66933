"""Why an input was refused."""

from __future__ import annotations


class LoadError(Exception):
    """Base of all load errors; ``details`` holds what a program may want to read."""

    def __init__(self, message: str, **details):
        super().__init__(message)
        self.details = details


class MissingPathError(LoadError):
    pass


class UnsupportedFormatError(LoadError):
    pass


class EmptyInputError(LoadError):
    pass


class CorruptInputError(LoadError):
    pass
