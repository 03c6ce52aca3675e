"""Compositions of operators: ETL, training, scoring, dashboard panels."""
