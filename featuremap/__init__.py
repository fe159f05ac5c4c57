"""featuremap: feature preparation and self-organizing-map segmentation on Spark."""

__version__ = "0.1.0"

from .errors import (DestinationError, PipelineError, SourceError,  # noqa: F401
                     TransformerError)
