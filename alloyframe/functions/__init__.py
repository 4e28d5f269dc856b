"""Functions of the materials-property engine."""
