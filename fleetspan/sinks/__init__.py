"""Table writers, exports and report documents."""
