"""Layer jobs, the mapping of the test tables onto raw records, and the
registered queries."""
