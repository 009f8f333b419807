"""Tidelog: reconciling, deletion-aware post analytics as Spark plans."""
