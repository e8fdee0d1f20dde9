"""Marts composed of the operators, and the queries that show each operator."""
