"""Transit views over the TPC-H-like test tables, the registered queries and their SQL."""
