"""Scalar functions: columns in, columns out, all JVM-side."""
