"""The registry of queries over the reference tables, each with the SQL that says the same where SQL can."""

from __future__ import annotations

from docketlake.plans import courts, files, records, texts, web

QUERIES = records.QUERIES | texts.QUERIES | web.QUERIES | files.QUERIES | courts.QUERIES
ORACLE_SQL = records.ORACLE_SQL | texts.ORACLE_SQL | web.ORACLE_SQL | files.ORACLE_SQL | courts.ORACLE_SQL
