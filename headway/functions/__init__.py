"""Column functions: times, names and numbers (``scalars``), answer texts (``texts``)."""
