"""All registered queries and their SQL."""

from __future__ import annotations

from tallygrid.checks import basics, business, graphs, marts, relational

_MODULES = (basics, relational, business, graphs, marts)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
SQL = {name: text for module in _MODULES for name, text in module.SQL.items()}
