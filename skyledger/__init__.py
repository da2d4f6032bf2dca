"""A PySpark engine that keeps an object catalog reconciled with a growing table of pointings."""
