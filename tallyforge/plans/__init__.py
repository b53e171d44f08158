"""Registered queries: each binds an operator to the model views and carries its oracle SQL."""
