"""The layers, from raw tables to marts, and the whole run."""
