"""Jobs: bronze to silver, silver to gold, reports and lookups."""
