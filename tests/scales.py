"""The table folders that tests read."""

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
