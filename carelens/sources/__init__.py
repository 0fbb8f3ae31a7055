"""Reading delimited files and configuration; writing tables and reports."""
