"""Contract queries over the driver's tables, each with an oracle in SQL where one exists."""
