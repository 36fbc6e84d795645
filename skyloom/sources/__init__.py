"""Sky-survey analytics: sources."""
