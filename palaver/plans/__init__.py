"""The processing chain and its binding to the driver's tables."""
