"""File sources, file sinks and table sinks."""
