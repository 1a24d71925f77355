"""The registered queries: the operators run over whole input tables, each with its SQL."""
