"""The expected results as SQL text, written independently of the Spark plans."""

from oracle.statements import statements

__all__ = ["statements"]
