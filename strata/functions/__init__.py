"""Column-level functions (scalar expressions). All return ``Column`` and stay
inside whole-stage codegen; no Python UDF lives here."""
