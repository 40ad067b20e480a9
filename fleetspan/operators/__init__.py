"""DataFrame operators over readings, engines and labels."""
