"""Exceptions raised by the library, one per failing condition."""

from __future__ import annotations


class DatasetError(ValueError):
    """Base of every error this package raises on purpose."""


class MissingParameterError(DatasetError):
    """A required argument or connection field is absent."""


class InvalidParameterError(DatasetError):
    """An argument has a value outside the accepted vocabulary."""


class UnsupportedTypeError(DatasetError):
    """A column type has no counterpart on the other side."""


class MissingFieldError(DatasetError):
    """A requested column does not exist in the dataset."""


class HeaderMissingError(DatasetError):
    """A CSV dataset has no usable header line."""


class InvalidPartitionSpecError(DatasetError):
    """A partition spec is malformed, unsafe, or absent where one is required."""


class SourceUnavailableError(DatasetError):
    """The storage system behind a dataset cannot be reached."""
