"""The models: staging, intermediate, marts, analyses, extracts and metric formulas."""
