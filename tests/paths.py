"""Where the given tables lie. A module of its own: two folders have a conftest, and only one can be imported by name."""

SF_SMOKE = "/root/testdata/sf0.001"
SF_SMALL = "/root/testdata/sf0.01"
