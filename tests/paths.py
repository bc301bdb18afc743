"""Places of the driver's tables."""

SMALL = "/root/testdata/sf0.001"
