"""Query plans over the driver's tables, the board registry and the endpoint catalogue."""
