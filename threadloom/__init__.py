"""threadloom: a PySpark-native engine for conversation data.

The core (``functions``, ``operators``, ``sources``, ``plans``, ``streaming``) never imports
``threadloom.llm``; that subpackage can be removed without breaking anything else.
"""
