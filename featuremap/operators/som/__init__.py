"""Self-organizing map: batch training, scoring and quality queries."""

from .config import SOMConfig, decay, default_grid_size, neighborhood  # noqa: F401
from .model import SOMModel  # noqa: F401
from .train import SOM  # noqa: F401
