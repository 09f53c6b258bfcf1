"""Reusable DataFrame operators: look-ups, funnels, windows, rules, features, top-N."""
