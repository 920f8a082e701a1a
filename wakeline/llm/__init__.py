"""Operators for preparing language-model training text, each built as Spark jobs.

Nothing outside this subpackage imports it. ``queries`` registers one query an operator; ``oracle`` holds plain SQL
that must give the same rows where SQL can express it.
"""
