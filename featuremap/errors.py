"""Exception hierarchy shared by every stage of the library."""


class PipelineError(Exception):
    """Base class: any failure while building or running a pipeline."""


class SourceError(PipelineError):
    """A source could not be read (missing path, unparsable content, ...)."""


class DestinationError(PipelineError):
    """A sink could not be written."""


class TransformerError(PipelineError):
    """A fit or apply step failed (bad parameters, unknown categories, ...)."""


class SOMError(TransformerError):
    """Base class of self-organizing-map errors."""


class InvalidConfigError(SOMError):
    """A map configuration value is out of range."""


class InsufficientDataError(SOMError):
    """Too few rows to train a map."""


class DimensionMismatchError(SOMError):
    """Feature count differs from the configured input length."""
