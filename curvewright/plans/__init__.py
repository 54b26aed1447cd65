"""Stage composition, input derivation and the registered queries."""
