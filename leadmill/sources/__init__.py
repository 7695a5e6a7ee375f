"""Where leads and settings come from, and where results go."""
