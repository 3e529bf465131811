"""Operator queries over the shared test tables, with their reference SQL."""
