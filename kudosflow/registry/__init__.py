from kudosflow.registry.oracle import oracle_sql
from kudosflow.registry.entries import queries

__all__ = ["oracle_sql", "queries"]
