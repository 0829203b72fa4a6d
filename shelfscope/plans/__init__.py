"""Composed plans: day/range runs, SQL views, registered queries."""
