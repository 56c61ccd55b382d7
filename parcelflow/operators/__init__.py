"""Operators: reports, integrity and quality checks, ETL steps, re-aimed table operations."""
