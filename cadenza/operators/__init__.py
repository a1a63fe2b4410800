"""DataFrame -> DataFrame operators; columns are arguments."""
