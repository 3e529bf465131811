"""refpanel: curate labelled sequence panels and benchmark detection methods on Spark."""

__version__ = "0.1.0"
