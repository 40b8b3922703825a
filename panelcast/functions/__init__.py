"""panelcast subpackage."""
