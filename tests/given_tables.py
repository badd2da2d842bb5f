"""Folders of the given tables."""

SMOKE = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
