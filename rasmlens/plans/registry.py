"""All queries by name, with their SQL where one exists."""

from rasmlens.plans import corpus, learning, oracle, streams, text

QUERIES = {**text.QUERIES, **corpus.QUERIES, **learning.QUERIES, **streams.QUERIES}
ORACLE_SQL = oracle.SQL
