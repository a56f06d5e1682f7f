"""Places of the given tables (a module of its own: test folders may have a conftest each)."""

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
