"""Operators for building training corpora: ten stand-alone operators over
``documents``, ``embeddings`` and ``pages``, their queries and SQL. Nothing
else in the library imports this subpackage."""
