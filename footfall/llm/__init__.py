"""Operators and stages that prepare training text."""
