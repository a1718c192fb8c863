"""Column functions and the NumPy kernels that run inside Arrow batches."""
