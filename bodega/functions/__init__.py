"""Business rules as ``Column -> Column`` functions."""
