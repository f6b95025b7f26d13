"""All queries of the crawl engine and the SQL that DuckDB can check them with."""

from larder.plans import crawls, fixtures, oracles, streams
from larder.plans import queries as Q

ORACLES = oracles.ORACLES | fixtures.oracles(oracles.canon, oracles.domain, oracles.LINKS, oracles.path, oracles.clean, oracles.language_code, oracles._KEYWORDS) | streams.ORACLES | crawls.ORACLES
#: Recipe extraction walks trees of HTML and JSON in Python, which SQL can't: fixtures test it.
QUERIES = {name: getattr(Q, name) for name in [*oracles.ORACLES, "extract_recipes"]} | fixtures.QUERIES | streams.QUERIES | crawls.QUERIES

__all__ = ["ORACLES", "QUERIES"]
