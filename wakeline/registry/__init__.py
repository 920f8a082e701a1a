"""The named queries over the test tables, and plain SQL that must give the same rows."""
