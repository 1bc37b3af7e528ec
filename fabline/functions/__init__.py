"""Column-level functions: decoders, conversions, fixed values."""
