"""umbra: evidence, quantification and statistics for metaproteomics tables on Spark."""

__version__ = "0.1.0"
