"""The library's queries by name, with their SQL."""

from __future__ import annotations

from . import links, names, places, records, records_sql, rules, stores

QUERIES = {**places.QUERIES, **names.QUERIES, **records.QUERIES, **links.QUERIES, **rules.QUERIES, **stores.QUERIES}
ORACLE_SQL = {**places.ORACLE_SQL, **names.ORACLE_SQL, **records_sql.ORACLE_SQL, **links.ORACLE_SQL, **rules.ORACLE_SQL, **stores.ORACLE_SQL}
