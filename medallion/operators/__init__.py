"""DataFrame operators; all lazy unless documented as computing statistics."""
