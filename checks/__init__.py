"""Every operator run over the given tables, next to the SQL that must give the same rows."""
