"""File sources, sinks and load profiles."""
