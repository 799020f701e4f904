"""martkit: raw trips to privacy-safe marts, as PySpark DataFrame functions."""
