"""End-to-end jobs composed of sources and operators."""
