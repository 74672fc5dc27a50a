"""Reusable operators over any DataFrame; the models in ``plans`` are built from them."""
