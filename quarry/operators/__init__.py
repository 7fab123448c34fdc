"""DataFrame -> DataFrame operators (quality, sessions, split, stats, FIM,
diffs, preferences) and the skew-safe building blocks they share."""
