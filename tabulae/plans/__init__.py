"""The two jobs: registry (company register) and trade (foreign trade by municipality)."""
