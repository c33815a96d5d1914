"""Graph operators: functions from DataFrame to DataFrame."""
