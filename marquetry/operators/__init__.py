"""Reusable DataFrame operators: joins, ranking, grouping, reshaping, pages."""
