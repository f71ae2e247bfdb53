"""Plans of the engine on the driver's tables: queries, and the SQL that must give the same rows."""
