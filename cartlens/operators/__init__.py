"""DataFrame -> DataFrame operators of the session log."""
