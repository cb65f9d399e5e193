"""All core queries by name, with the SQL they are checked against."""

from . import blocks, catalog, documents, inventories, more, nested, runs, state, vectors  # noqa: F401  (each registers its queries)
from .base import QUERIES, SQL  # noqa: F401
