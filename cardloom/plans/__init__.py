"""Multi-step jobs: load, lake layers, datamart refresh, SQL surface."""
