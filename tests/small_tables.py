"""Where the smallest of the given tables lie. (A module of its own name: a
conftest is not importable by name once a folder below has one too.)"""

SF_SMALL = "/root/testdata/sf0.001"
