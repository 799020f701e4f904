"""Reading, landing and writing of layers."""
