"""Where the tests read the given tables."""

SF_DIR = "/root/testdata/sf0.001"
