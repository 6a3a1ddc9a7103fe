"""Spark-native analytics over documents, markup project trees and training text."""
