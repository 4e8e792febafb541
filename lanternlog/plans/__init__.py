"""Ready queries over log views of the test tables, with their SQL."""
