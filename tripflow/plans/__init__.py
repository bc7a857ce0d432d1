"""The trip model: staging, fact, dimensions and reports."""
