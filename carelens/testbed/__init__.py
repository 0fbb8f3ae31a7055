"""The report tables derived from the driver's test tables, the registered queries and their reference SQL."""
