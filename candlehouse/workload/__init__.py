"""The registered queries: every operator over the given test tables, with its SQL counterpart."""
