"""Where the supplied tables lie."""

SMALL = "/root/testdata/sf0.001"
