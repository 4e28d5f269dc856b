"""Sources of the materials-property engine."""
