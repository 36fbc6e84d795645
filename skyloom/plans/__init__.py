"""Sky-survey analytics: plans."""
