"""Writers and reports."""
