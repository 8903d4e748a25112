"""millrace: incremental ELT and dimensional modelling as Spark DataFrame operators."""

__version__ = "0.1.0"
