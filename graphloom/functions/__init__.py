"""Column functions and the pure Python kernels behind the Arrow functions."""
