"""The load as a file stream."""
