"""Sources: driver tables, reference-shaped stand-ins derived from them,
message streams and seed lists."""
