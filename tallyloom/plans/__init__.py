"""The reports: whole plans composed of the operators."""
