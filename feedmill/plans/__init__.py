"""End-to-end flow and the registered queries."""
