"""The observation model: table definitions, code tables and the retrieval columns."""
