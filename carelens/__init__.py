"""Establishment reporting on Spark: clean, aggregate and join care-establishment data into wide reports."""
