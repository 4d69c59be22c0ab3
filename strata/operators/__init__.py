"""Relational operators: ``DataFrame -> DataFrame`` functions built on Spark SQL
built-ins, usable with ``df.transform(...)``."""
