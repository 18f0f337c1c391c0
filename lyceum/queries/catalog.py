"""All registered queries."""

from lyceum.queries import building_blocks, live, products, streams  # noqa: F401
from lyceum.queries.registry import ORACLES, QUERIES  # noqa: F401
