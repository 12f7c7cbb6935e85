"""Reports: one function per report family, each ``(star, span, ...) -> DataFrame``."""
