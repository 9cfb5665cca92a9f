"""Readers, loaders and the shop-shaped views."""
