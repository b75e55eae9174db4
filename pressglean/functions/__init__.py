"""Part of pressglean."""
