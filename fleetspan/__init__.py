"""fleetspan: fleet health and remaining-life analytics as Spark jobs."""
