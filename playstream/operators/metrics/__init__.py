"""Evaluation metrics as distributed aggregates (EV-01 .. EV-13, SE-01).

The reference computes these on one machine (numpy / scikit-learn arrays).
Here each metric is a DataFrame -> DataFrame aggregate: partial aggregates
before one shuffle, small intermediate tables (confusion or contingency
cells, per-cluster centroids) whose size is bounded by the label domain.
"""
