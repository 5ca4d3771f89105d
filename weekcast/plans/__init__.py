"""Entry points (pipeline) and the query registry used by the driver contract."""
