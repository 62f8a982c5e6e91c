"""The registered queries: ``{name: (run(spark, sf_dir), DuckDB SQL)}``."""

from nearfield.plans import assembly, delivery, neighbors

REGISTRY = {**neighbors.QUERIES, **assembly.QUERIES, **delivery.QUERIES}
