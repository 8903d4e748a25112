"""The model built from the operators: staging, marts, loads, reports."""
