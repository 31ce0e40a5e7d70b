"""stepweave: curation of step-ordered episodes as Spark DataFrame plans."""

__version__ = "0.1.0"
