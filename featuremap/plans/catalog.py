"""Imports every catalogue module so that the registry is complete."""

from . import q_encode, q_flow, q_online, q_prep, q_scale, q_segment, q_som, q_stream  # noqa: F401
from .registry import HEADLINE, ORACLE, QUERIES  # noqa: F401
