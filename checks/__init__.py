"""Query bindings on the test tables and their independent SQL counterparts."""
