"""Column functions and Python kernels."""
