"""Where the tests' small tables are."""

SF_SMALL = "/root/testdata/sf0.001"
