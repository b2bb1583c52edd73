"""All registered queries."""

from . import activity, depth, filters, io, launch, modelling, textmine  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
