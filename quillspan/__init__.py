"""quillspan: agent-transcript and corpus processing as PySpark DataFrame transforms."""

__version__ = "0.1.0"
