"""Where data comes from and goes to: catalogs, databases over JDBC, staged text."""
