"""Named queries over the driver tables, with oracle SQL."""
