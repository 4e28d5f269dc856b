"""Plans of the materials-property engine."""
