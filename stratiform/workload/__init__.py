"""The operators on the given tables, each with SQL that says what it should give."""
