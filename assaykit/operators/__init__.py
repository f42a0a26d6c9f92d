"""DataFrame -> DataFrame steps; nothing here writes."""
