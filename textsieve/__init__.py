"""Spark-native preparation of raw text and web pages into a clean corpus."""

from textsieve.config import PrepConfig

__all__ = ["PrepConfig"]
