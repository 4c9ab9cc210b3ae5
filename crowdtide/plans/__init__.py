"""The five jobs: clean, merge, features, signals, pages."""
