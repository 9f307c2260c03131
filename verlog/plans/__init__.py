"""The scripted history on the driver data and the registered query catalogue."""
