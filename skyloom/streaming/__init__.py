"""Sky-survey analytics: streaming."""
