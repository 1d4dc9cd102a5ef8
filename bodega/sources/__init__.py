"""Readers: JDBC, stored tables, the generated calendar and the TPC-H-shaped test tables."""
