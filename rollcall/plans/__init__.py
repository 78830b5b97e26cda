"""End-to-end jobs made of sources, operators and sinks."""
