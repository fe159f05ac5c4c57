"""Fitted stages: scalers, power transforms, encoders, preparation, profiling,
joins, segmentation and the self-organizing map."""

from .encode import HashEncoder, LabelEncoder, OneHotEncoder, TargetEncoder  # noqa: F401
from .power import PowerTransformer  # noqa: F401
from .prep import AutoPrep, MedianImputer, ModeImputer  # noqa: F401
from .scale import LogTransformer, MinMaxScaler, RobustScaler, ZScoreScaler  # noqa: F401
