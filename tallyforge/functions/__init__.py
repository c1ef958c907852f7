"""Scalar functions: text, similarity, geometry and raster kernels."""
