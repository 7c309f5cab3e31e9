"""Folders of the given tables that the tests read."""

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"
