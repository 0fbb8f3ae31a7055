"""Report plans composed from the operators."""
