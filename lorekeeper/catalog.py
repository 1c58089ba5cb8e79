"""All queries of the engine, by name, with the SQL that each is held against."""

from lorekeeper.plans import classifiers, coding, collection, core, decisions, exports, migration, ordering, places, promotion, quality, release, rollups, series, texts  # noqa: F401  registers its queries
from lorekeeper.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
