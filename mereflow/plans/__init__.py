"""Queries that apply the operators."""

#: Modules with QUERIES and ORACLE.
CATALOGUE = ("queries", "cycle_queries", "grid_queries", "geometry_queries", "product_queries")
