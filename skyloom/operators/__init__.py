"""Sky-survey analytics: operators."""
