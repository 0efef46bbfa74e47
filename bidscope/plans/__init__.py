"""Warehouse queries, the ETL run and the registered queries."""
