"""Life prediction and anomaly detection."""
