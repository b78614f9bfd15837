"""The same cleaning on streams."""
