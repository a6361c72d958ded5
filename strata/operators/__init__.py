"""Operators: interval joins, history repair, ranking, layout."""
