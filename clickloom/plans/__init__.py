"""Input bindings, registered queries, their SQL counterparts, and jobs."""
