"""Stage plans and the registered queries."""
