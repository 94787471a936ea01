"""The versioned store, the commands built on it, and the registered queries."""
