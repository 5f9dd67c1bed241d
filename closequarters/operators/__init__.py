"""DataFrame -> DataFrame operators."""
from . import encounters, filters, jumps, projections, ranking, trajectory, vessels  # noqa: F401
