"""Sky-survey analytics: functions."""
