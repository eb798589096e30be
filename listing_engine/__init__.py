"""Listing-feed analytics on Spark: change-feed fold, payload normalisation,
dictionary translation and untranslated-text mining as DataFrame plans."""

__version__ = "0.1.0"
