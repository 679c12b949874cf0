"""The reports: operators applied to the tables, with the SQL that states their results."""
