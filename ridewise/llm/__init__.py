"""Operators of a training-data pipeline. Nothing outside this subpackage
imports it; its queries are registered in ``ridewise.llm.queries``."""
