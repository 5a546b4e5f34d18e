"""Driver tables bound to the domain, the registered queries, and their SQL counterparts."""
