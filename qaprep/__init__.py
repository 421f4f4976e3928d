"""Spark-native preparation and scoring of question-answer data from molecule tables."""

from qaprep.session import configure, staging_folder, write_through

__all__ = ["configure", "staging_folder", "write_through"]
