"""The registered queries and their SQL twins, used by ``__spark_entry__.py``, the tests and the bench."""
