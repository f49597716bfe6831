"""Jobs composed of several operators, and the registered queries."""
