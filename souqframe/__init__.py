"""Cleaning, auditing, storing and reporting on e-commerce orders with PySpark."""

__version__ = "0.1.0"
